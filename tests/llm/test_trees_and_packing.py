"""The conversation trie, the Merkle manifest and the packing of documents."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from parallex.llm import centroids, conversation_trie, merkle, packing
from tests.llm import tables

CONV = "conv_id long, turn long, role string, text string, depth string, id string, way string"


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


def conversation_rows():
    rng = random.Random(4)
    rows = []
    for c in range(120):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["yes", "no thanks", "tell me more"])))
    rows += [(200, t, "user", f"turn {t}") for t in range(90)] + [(203, t, "user", f"turn {t}") for t in range(95)]
    rows += [(300 + i, t, "user", "the same conversation") for i in range(60) for t in range(4)]
    # a conversation left without turns, one alone, NULLs, ties and repeated rows, empty texts
    rows += [(411, 0, "user", "x"), (509, 0, "user", "lost"), (600, None, None, None), (600, None, "a", ""), (600, 1, "b", " \t "),
             (600, 1, "b", " \t "), (None, 0, "user", "nobody"), (620, 3, "user", "日本 語"), (621, 3, "user", "v " * 30_000)]
    return rows


def brute_trie(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    for v in own.values():
        v.sort()
    node, ends, kids = defaultdict(list), defaultdict(list), defaultdict(list)
    node[()] = []
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        seq = [q[2:] for q in own.get(c - c % 20, [])[:h] + own[c][h:]]
        for d in range(len(seq) + 1):
            node[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    for k in node:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(node, key=len, reverse=True):
        w = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + max(len(node[k]) - 1, 0) * w
    return [(min(v, default=None), len(k), min(node[k[:-1]], default=None) if k else None, len(v), len(kids[k]), leaves[k], saved[k],
             hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, v in node.items()]


@pytest.mark.parametrize("block,chunk", [(1 << 16, 1024), (25, 4)])
def test_trie_equals_brute_force(spark, block, chunk):
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], CONV).repartition(3)
    got = [tuple(r) for r in conversation_trie.trie(df, block, chunk).collect()]
    assert _sorted(got) == _sorted(brute_trie(rows))


def test_trie_equals_sql(spark, tmp_dir):
    rows = [r for r in conversation_rows() if r[0] != 621]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_dir}/conversations.parquet")
    got = tables.result(conversation_trie.op11_conversation_trie(spark, tmp_dir))
    assert got == tables.sql(tmp_dir, conversation_trie.ORACLE, ("conversations",))


def test_trie_of_nothing(spark):
    got = conversation_trie.trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect()
    assert [tuple(r) for r in got] == [(None, 0, None, 0, 0, 1, 0, hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("kind", ["chain", "thin", "star", "any"])
def test_subtree_sums(kind):
    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 40, 2000):
        lowest = {"chain": lambda i: i - 1, "thin": lambda i: max(0, i - 3), "star": lambda i: 0, "any": lambda i: 0}[kind]
        parent = np.array([-1] + [0 if kind == "star" else int(rng.integers(lowest(i), i)) for i in range(1, n)])
        values, sub = rng.integers(-5, 9, (n, 2)), rng.integers(1, 6, n)
        want = values.copy()
        for i in range(n - 1, 0, -1):
            sub[parent[i]] += sub[i]
            want[parent[i]] += want[i]
        assert (centroids.subtree_sums(parent, sub, values) == want).all()


def _digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_manifest(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def low(t):
        return t if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)

    def tree(level):
        out = [level]
        while len(out[-1]) > 1:
            out.append([_digest("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
        return out

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            a = i - i % 16
            out.append(("".join(level[a:i]), "".join(level[i + 1:a + 16])))
            i //= 16
        return out

    groups = defaultdict(list)
    for r in rows:
        bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        whole = "".join(map(field, r))
        groups[r[1]].append((r[0], _digest(whole), _digest("".join(map(field, (*r[:4], low(r[4]))))) if bad else _digest(whole)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = tree([x[1] for x in groups[g]])
    top, out = tree([trees[g][-1][0] for g in names]), []
    for k, g in enumerate(names):
        for i, (doc_id, h, node) in enumerate(groups[g]):
            p = path(trees[g], i) + path(top, k)
            for a, b in p:
                node = _digest(a + node + b)
            root = top[-1][0]
            out.append((doc_id, h, trees[g][-1][0], root, _digest("".join(a + b for a, b in p)), node, node == root))
    return out


def _manifest(spark, folder):
    return merkle.op12_merkle_manifest(spark, folder)


def test_manifest_of_awkward_rows(spark, tmp_dir):
    tables.documents(spark, tmp_dir)
    rows = [tuple(r) for r in spark.read.parquet(f"{tmp_dir}/documents.parquet").select(*merkle.COLUMNS).collect()]
    got = [tuple(r) for r in _manifest(spark, tmp_dir).collect()]
    assert _sorted(got) == _sorted(brute_manifest(rows))
    assert tables.result(_manifest(spark, tmp_dir)) == tables.sql(tmp_dir, merkle.ORACLE)


@pytest.mark.parametrize("sources,each", [(1, 1), (1, 5000), (300, 1), (20, 17)])
def test_manifest_of_any_height(spark, tmp_dir, sources, each):
    rows = [(i, f"s{i % sources}", "en", None, f"Text {i // 2}") for i in range(sources * each)]
    rows += [(i, "s0", "en", 3, "hot") for i in range(10 ** 6, 10 ** 6 + 300 * (each == 17))]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(
        f"{tmp_dir}/documents.parquet")
    assert _sorted([tuple(r) for r in _manifest(spark, tmp_dir).collect()]) == _sorted(brute_manifest(rows))


def test_manifest_of_nothing(spark, tmp_dir):
    tables.documents(spark, tmp_dir, data=[])
    assert _manifest(spark, tmp_dir).collect() == []


def _naive(lengths, window):
    free = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, c in enumerate(free) if c >= n]
        if fit:
            free[min(fit, key=lambda i: free[i])] -= n
        else:
            free.append(window - n)
    return sorted(free)


def test_best_fit_decreasing_equals_piece_by_piece():
    rng = random.Random(5)
    for _ in range(150):
        window = rng.choice([1, 4, 7, 16, 33, 64])
        lengths = [rng.randint(1, rng.choice([window, window // 2 + 1])) for _ in range(rng.randint(1, 90))]
        lengths = [min(n, window) for n in lengths] + [rng.randint(1, window)] * rng.randint(0, 50)
        steps, fill = packing.best_fit_decreasing(Counter(lengths), window).tolist(), defaultdict(list)
        for n, count in Counter(lengths).items():
            for rank in range(count):
                s = [x for x in steps if x[0] == n and x[1] <= rank][-1]
                into, nth = divmod(rank - s[1], s[3])
                fill[s[2] + into].append((s[4] + nth * n, n))
        assert sorted(fill) == list(range(len(fill)))
        free = []
        for parts in fill.values():
            end = 0
            for at, n in sorted(parts):
                assert at == end
                end += n
            free.append(window - end)
        assert min(free) >= 0 and sorted(free) == _naive(lengths, window)


def test_encoder_gives_the_ids_of_the_vocabulary_file():
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(packing.vocabulary_path())
    own.encode_special_tokens = True
    texts = [t for t in tables.texts() if t] + ["", " ", "  a", "a  b", "a b ", "x　y z", "don't we'll 'tis", "<|endoftext|> a", "日本語 テキスト",
                                               "a b c", "x" * 5000, "a \x1c b c\x1fd", "é è́ ü", "🙂 👍🏽 z", "tab\there a\tb", "\r\n \n"]
    want = [np.array(e.ids, "<u4").tobytes() for e in own.encode_batch(texts, add_special_tokens=False)]
    assert packing.Encoder(packing.vocabulary_path()).encode(texts) == want


def test_packing_is_a_round_trip(spark, tmp_dir):
    docs = tables.documents(spark, tmp_dir)
    packed = packing.pack(docs).cache()
    encoder = packing.Encoder(packing.vocabulary_path())
    want = Counter((r["doc_id"], encoder.encode([r["text"] or ""])[0] + bytes(4)) for r in docs.collect())
    rows, groups = packed.collect(), defaultdict(list)
    copies = defaultdict(lambda: defaultdict(list))
    for r in rows:
        copies[r["doc_id"], r["doc_tokens"]][r["start"]].append(bytes(r["tokens"]))
        groups[r["sequence_id"]].append((r["offset"], r["length"], bytes(r["tokens"])))
    whole = Counter()
    for (doc_id, n), starts in copies.items():
        for parts in zip(*[sorted(starts[s]) for s in sorted(starts)], strict=True):
            body = b"".join(parts)
            assert len(body) == 4 * n
            whole[doc_id, body] += 1
    assert whole == want
    assert sorted(groups) == list(range(len(groups)))
    assert sorted(packing.WINDOW - sum(p[1] for p in g) for g in groups.values()) == _naive([r["length"] for r in rows], packing.WINDOW)
    for r in packing.sequences(packed).collect():
        body = b"".join(p[2] for p in sorted(groups[r["sequence_id"]]))
        full = r["n_tokens"] & (r["n_tokens"] - 1) == 0 or len(r["tokens"]) == 4 * packing.WINDOW
        assert bytes(r["tokens"])[:len(body)] == body and not any(bytes(r["tokens"])[len(body):]) and full
    query = {(r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in packing.op13_packing(spark, tmp_dir).collect()}
    assert query == {(r["doc_id"], r["start"], r["length"], zlib.crc32(bytes(r["tokens"])), r["doc_tokens"]) for r in rows}


def test_packing_of_nothing(spark, tmp_dir):
    tables.documents(spark, tmp_dir, data=[])
    assert packing.op13_packing(spark, tmp_dir).collect() == []
    assert packing.sequences(packing.pack(tables.documents(spark, data=[]))).collect() == []
