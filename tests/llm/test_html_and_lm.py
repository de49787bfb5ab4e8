import math
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import tables  # noqa: E402

from parallex.llm import bitmix, html_extract, lm_scoring  # noqa: E402
from parallex.llm.crf import Crf  # noqa: E402
from parallex.llm.html_blocks import blocks  # noqa: E402

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";x()</script></head>
<body><header>Site</header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></ul></nav><!-- no <p>this</p> -->
<div class="cookie-notice">We use cookies. <a href=x>More</a></div>
<article><h1>Title &amp; more</h1><p><b>First&nbsp;para
graph<br>goes on &lt;here&gt;.<p>Sec<i>ond</i> one.</p><div class="ad">Buy this now</div><ul><li>item a<li>item b</ul>
<form><label>Search</label><input></form></article>
<section id="comments"><div class="comment"><p>I liked this very much, thank you.</p></div></section>
<aside class="sidebar"><a href="/r">Related story</a></aside><footer>&copy; 2020 Site &middot; all rights.</footer></body></html>"""


# ---- HTML ----------------------------------------------------------------------

def test_page(spark):
    rows = [(1, "u", PAGE, "x"), (None, None, None, "x"), (3, "u", "", "x"), (4, "u", "<article><p>cut off &amp the<b", "x"), (1, "u", PAGE, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [(r.page_id, r.text, r.n_chars) for r in html_extract.extract(df).collect()]
    text = "Title & more\nFirst para graph goes on <here>.\nSecond one.\nitem a\nitem b"
    assert got == [(1, text, len(text)), (None, "", 0), (3, "", 0), (4, "cut off & the", 13), (1, text, len(text))]
    assert html_extract.extract(df.limit(0)).count() == 0


def test_held_out_labels():
    for page, labels in html_extract.training_pages(60, 3):
        assert len(blocks(page)) == len(labels)
    model = html_extract.trained()
    wrong = total = 0
    for page, labels in html_extract.training_pages(150, 77):
        got = model.decode(html_extract.features(blocks(page)))
        wrong += sum(a != b for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert wrong < 0.01 * total


def test_given_pages_keep_exactly_the_article(spark):
    model = html_extract.trained()
    for r in spark.read.parquet(f"{'/root/testdata/sf0.001'}/pages.parquet").collect():
        found = blocks(r.html)
        assert html_extract.main_text(r.html, model) == "\n".join(b.text for b in found if "article" in b.tags)


def test_viterbi_and_marginals_equal_enumeration():
    crf = Crf()
    crf.weights, crf.steps = {"a": 0.7, "b": -1.1, "c": 0.2}, [[0.3, -0.5], [0.1, 0.9]]
    chain = [["a"], ["b", "c"], ["c"], ["b"], ["a", "b"]]

    def score(y):
        return sum(sum(crf.weights[f] for f in c) for c, v in zip(chain, y, strict=True) if v) + sum(
            crf.steps[i][j] for i, j in zip(y, y[1:], strict=False))
    every = [[n >> i & 1 for i in range(5)] for n in range(32)]
    z = sum(math.exp(score(y)) for y in every)
    assert crf.decode(chain) == max(every, key=score)
    p, steps = crf.marginals(chain)
    for i in range(5):
        assert abs(p[i] - sum(math.exp(score(y)) for y in every if y[i]) / z) < 1e-9
    assert abs(sum(map(sum, steps)) - 4) < 1e-9


def test_odd_markup_does_not_stop_it():
    for page in ("<", "<>", "</", "<p", "<p a='", '<a href="x', "<!--", "<script>", "&", "a<b", "<p>" * 500 + "x", "</p>" * 50, "<table><tr><td>a<td>b<tr><td>c</table>"):
        blocks(page)
    assert [b.text for b in blocks("a < b and c<d")] == ["a < b and c"] or blocks("a < b")[0].text == "a < b"
    assert [b.text for b in blocks("<table><tr><td>a<td>b<tr><td>c</table>")] == ["a", "b", "c"]


# ---- language model ------------------------------------------------------------

def lm_rows():
    extra = [(5002, "x" * 200 + " Y" + "Z" * 63 + " " + "q" * 62 + "\n" + "é" * 80 + " \t\n  end"), (5003, "same"), (5003, "same")]
    return tables.rows() + [(i, t, "en", "s", 1, *tables.CLASH) for i, t in extra]


def test_scores(spark, tmp_dir):
    rows = lm_rows()
    tables.documents(spark, tmp_dir, data=rows)
    words = Counter()

    def held(i):
        return zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    for r in rows:
        if not held(r[0]):
            words.update([*(r[1] or "").encode().lower().split(), None])
    n, v = sum(words.values()), len(words)
    want = []
    for r in rows:
        tokens = [*(r[1] or "").encode().lower().split(), None]
        base = sum(math.log10((words[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        want.append((str(r[0]), held(r[0]), len(tokens), sum(words[t] > 0 for t in tokens), n, round(base, 6)))
    out = lm_scoring.op7_lm_scoring(spark, tmp_dir).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == sorted(want)
    for r in out:
        assert r.score < 0 and r.bits_per_byte > 0
    text = {r[0]: r[1] for r in rows}
    prose = [r for r in out if r.doc_id is not None and r.doc_id < 25]
    size = sum(len(text[r.doc_id].encode()) + 1 for r in prose if r.held_out)
    assert -sum(r.score for r in prose if r.held_out) * math.log2(10) / size < 4.5  # held-out bits per byte; letters alone take 8


def test_scores_without_training_texts(spark, tmp_dir):
    rows = [(None, "a b", "en", "s", 1, *tables.CLASH), (None, None, "en", "s", 1, *tables.CLASH)]
    tables.documents(spark, tmp_dir, data=rows)
    got = sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in lm_scoring.op7_lm_scoring(spark, tmp_dir).collect())
    assert got == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]  # 0.1 / (0 + 0.1 * 1) for every token


def test_empty_table(spark, tmp_dir):
    tables.documents(spark, tmp_dir, data=[])
    assert lm_scoring.op7_lm_scoring(spark, tmp_dir).count() == 0


def test_units_cover_the_text_and_sum_to_one():
    for text in (b"", b"a", b"a b", b"\n\n a ", b"x" * 200 + b" y", "é ü\t".encode() * 9):
        found = [k.removeprefix(bitmix.CUT) for k in bitmix.keys(text) if k[:1] != bitmix.WORD_MARK]
        assert b"".join(found) == text + b"\xff"
    assert bitmix.keys(b"x" * 64) == [b"x" * 63, bitmix.CUT + b"x\xff", bitmix.WORD_MARK + b"x" * 64]
    found = [b"the ", b"then ", b"other ", b"a\n"]
    tabs = [*bitmix.new_global(), *bitmix.new_local()]
    bitmix.learn_counts(bitmix.Units(found, np.array([50, 3, 4, 9])), tabs)
    weights, refine = bitmix.new_weights(), np.zeros((256, bitmix.CELLS, 2))
    bitmix.learn_weights(bitmix.Units(found, np.array([50, 3, 4, 9])), tabs, weights, np.zeros_like(weights), refine)
    model = bitmix.Scorer(tabs, weights, refine)
    for prefix in (b"t", b"the", b"othe"):
        every = [prefix + bytes([b]) for b in range(0xfd)]  # marks aside: their share is nearly zero
        p = 10 ** model.log_probability(bitmix.Units(every, np.zeros(256)))
        whole = float(10 ** model.log_probability(bitmix.Units([prefix], np.zeros(1)))[0])
        assert abs(p.sum() / whole - 1) < 0.02


def test_first_bytes_sum_to_one_after_any_word():
    found = [b"the ", b"then ", b"other ", b"a\n", b"\xff", b"x" * 63, bitmix.CUT + b"x\xff", bitmix.WORD_MARK + b"x" * 64]
    lead, first = bitmix.traits(found)
    codes, text = bitmix.first_codes([np.array(a, np.int64) for a in ([0, 3, 1, 0, 2, 4], [], [5, 6, 7], [4])], lead, first)
    assert text.tolist() == [0] * 6 + [2] * 2 + [3]  # the long word's own key is no unit
    assert (codes >> 9).tolist() == [bitmix.START, *lead[[0, 3, 1, 0, 2]], bitmix.START, lead[5], bitmix.START]
    assert (codes & 511).tolist() == [*b"tatto\xffx", 256 + ord("x"), 0xff]
    tabs, weights, refine = bitmix.Firsts.tables(), bitmix.new_weights(), np.zeros((256, bitmix.CELLS, 2))
    bitmix.learn_counts(bitmix.Firsts(codes, np.full(len(codes), 7)), tabs)
    bitmix.learn_weights(bitmix.Firsts(codes, np.full(len(codes), 7)), tabs, weights, np.zeros_like(weights), refine)
    model = bitmix.Scorer(tabs, weights, refine)
    for before in {*codes >> 9, 12345}:
        p = 10 ** model.log_probability(bitmix.Firsts(before * 512 + np.arange(256), np.zeros(256)))
        assert abs(p.sum() - 1) < 0.001


def _plain_slots(kind: int, unit: bytes, t: int, node: int, bits: int) -> list[int]:
    """The four table rows of a bit, from the hashing rule, with Python integers."""
    full = (1 << 64) - 1
    k = [int(x) for x in bitmix._K]
    prefix = 0x243F6A8885A308D3
    for byte in unit[:t]:
        prefix = (prefix ^ (byte + 1)) * k[0] & full
        prefix ^= prefix >> 32
    one = unit[t - 1] + 1 if t else 0
    two = (unit[t - 2] + 1 if t > 1 else 0) * 257 + one if t else 0
    contexts = [kind * 8 + min(t, 3), one * 4 + min(t, 2), two * 4 + min(t, 3), (prefix + kind) & full]
    out = []
    for c, factor, width in zip(contexts, k, [*bitmix.GLOBAL_BITS, bits], strict=False):
        h = ((c + 1) * factor & full ^ (node * k[2] & full)) * k[3] & full
        h ^= h >> 29
        out.append((h * k[1] & full) >> (64 - width))
    return out


def test_usual_word_order_scores_higher(spark, tmp_dir):
    rng = random.Random(8)
    rows = [(i, " ".join(f"{a} {b}" for a, b in rng.choices([("red", "apple"), ("blue", "sky"), ("old", "tree")], k=20)), "en", "s", 1, *tables.CLASH)
            for i in range(60)]
    rows += [(60, "red apple blue sky old tree", "en", "s", 1, *tables.CLASH), (61, "red sky blue tree old apple", "en", "s", 1, *tables.CLASH)]
    tables.documents(spark, tmp_dir, data=rows)
    got = {r.doc_id: r.score for r in lm_scoring.op7_lm_scoring(spark, tmp_dir).collect()}
    assert got[60] > got[61] + 1


def test_scores_equal_a_plain_model(spark, tmp_dir):
    """Counts, gates, mixing, refinement, dealing and lookups against a loop over bits;
    mixing weights and refinement counts are those that were learned."""
    rng = random.Random(3)
    vocabulary = ["the", "cat", "sat", "mat", "Über", "on", "x" * 70, "then", "catalogue", ""]
    rows = [(i, rng.choice([" ", "\n", "  "]).join(rng.choices(vocabulary, k=rng.randint(0, 30))), "en", "s", 1, *tables.CLASH) for i in range(30)]
    rows += [(30, "the cat sat on the mat", "en", "s", 1, *tables.CLASH), (31, "cat the the sat on mat", "en", "s", 1, *tables.CLASH),
             (None, None, "en", "s", 1, *tables.CLASH), (30, "the cat", "en", "s", 1, *tables.CLASH)]
    tables.documents(spark, tmp_dir, data=rows)
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet").select("doc_id", "text")
    got = sorted((str(r.doc_id), r.score) for r in lm_scoring.score(docs).collect())

    units, send = lm_scoring._units(docs), spark.sparkContext.broadcast
    low, dealing = send(lm_scoring._low_orders(units)), lm_scoring._hot(units)
    mixer = lm_scoring._mixer(units, low, send({}), dealing)
    _, *first_mixer = lm_scoring._firsts(docs)

    def pieces(text):
        found = [k for k in bitmix.keys((text or "").encode()) if k[:1] != bitmix.WORD_MARK]
        return [(k[:1] == bitmix.CUT, k.removeprefix(bitmix.CUT)) for k in found]

    def bits(text):
        """(model, slots, node, bit) of every bit of the text."""
        word = b"\xff"
        for kind, unit in pieces(text):
            end = zlib.crc32(word[-2:]) % bitmix.END_CLASSES ^ kind * 0x2D5
            lead = zlib.crc32(word) % bitmix.WORD_CLASSES ^ kind * 0xA5A
            for t, byte in enumerate(unit):
                for b in range(8):
                    node = (256 | byte) >> (8 - b)
                    if t == 0:
                        yield 0, [int(kind) * 256 + node, None, end * 256 + node, lead * 256 + node], node, byte >> (7 - b) & 1
                    else:
                        found = _plain_slots(int(kind), unit, t, node, bitmix.LOCAL_BITS)
                        yield 1, found if t >= bitmix.LOCAL_FROM else [*found[:3], None], node, byte >> (7 - b) & 1
            word = re.sub(rb"[\s\xff]", b"", unit).lower()
    seen = Counter()
    for r in rows:
        if zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 10:
            seen.update((m, i, s, bit) for m, slots, _, bit in bits(r[1]) for i, s in enumerate(slots))
    want = []
    for r in rows:
        total = 0.0
        for m, slots, node, bit in bits(r[1]):
            weights, refine = (first_mixer, mixer)[m]
            n = {i: [seen[m, i, s, b] for b in (0, 1)] for i, s in enumerate(slots) if s is not None}
            gate = (sum(n[2]) > 30) + (sum(n[2]) > 3000)
            if 3 in n:
                gate += 3 * (1 + sum(sum(n[3]) > x for x in (0, 2, 15, 255)))
            dot = weights[gate][-1] * 0.3 + sum(
                weights[gate][i] * max(-12, min(12, math.log((one + 0.05) / (zero + 0.05)))) for i, (zero, one) in n.items())
            zero, one = refine[node][round((max(-8, min(8, dot)) + 8) * 2)]
            p = 0.5 / (1 + math.exp(-dot)) + 0.5 * (one + 50 / (1 + math.exp(-dot))) / (zero + one + 50)
            total += math.log10(p if bit else 1 - p)
        want.append((str(r[0]), total))
    for (a, x), (b, y) in zip(got, sorted(want), strict=True):
        assert a == b and abs(x - y) < 2e-3 * max(1, abs(y)), (a, x, y)
    assert abs(dict(got)["31"] - next(y for a, y in got if a == "30" and y < -5)) > 0.02  # other order, other score


def test_split_equals_a_plain_scan_of_each_text():
    rng = random.Random(7)
    words = [rng.choice(["Ab", "é\0", "x"]) * n for n in (0, 1, 3, 20, 31, 32, 62, 63, 64, 125, 126, 127, 300)]
    texts = [None, b"", b" "] + ["".join(rng.choice(words) + rng.choice([*" \t\n\r\x0b\x0c", "  "]) for _ in range(rng.randint(0, 9))).encode()
                                 + rng.choice([b"", b"end"]) for _ in range(200)]
    unit = re.compile(rb"[^\x20\x09-\x0D\xff]{0,62}[\x20\x09-\x0D\xff]|[^\x20\x09-\x0D\xff]{63}")
    want = []
    for text in texts:
        found, on = [], False
        for u in unit.findall((text or b"") + b"\xff"):
            found.append(bitmix.CUT + u if on else u)
            on = len(u) == 63 and u[-1:] not in b" \t\n\r\x0b\x0c\xff"
        want.append(found + [bitmix.WORD_MARK + w.lower() for w in (text or b"").split() if len(w) >= 63])
    keys, of = bitmix.split(texts)
    got = [[] for _ in texts]
    for k, i in zip(keys.to_pylist(), of, strict=True):
        got[i].append(k)
    assert got == want
    keys = sorted({k for found in want for k in found})
    lead, first = bitmix.traits(keys)
    assert bitmix.crc(keys).tolist() == [zlib.crc32(k) for k in keys]
    for k, a, b in zip(keys, lead.tolist(), first.tolist(), strict=True):
        cut = k[:1] == bitmix.CUT
        assert b == (-1 if k[:1] == bitmix.WORD_MARK else k.removeprefix(bitmix.CUT)[0] + 256 * cut)
        assert b < 0 or a == bitmix._lead(k[cut:].rstrip(b" \t\n\r\x0b\x0c\xff").lower())


@pytest.mark.parametrize("same_hash", [False, True])
def test_places_of_keys(monkeypatch, same_hash):
    keys = [b"a ", b"b\n", b"", b"\xff", bitmix.CUT + b"a ", b"y" * 63, bitmix.WORD_MARK + b"y" * 63, bitmix.WORD_MARK + b"y" * 90]
    if same_hash:
        monkeypatch.setattr(bitmix, "hashes", lambda found: np.ones(len(found), np.uint64))
    places = lm_scoring._finder(pa.array(keys, pa.large_binary()))
    assert places(pa.array([keys[i] for i in (7, 0, 3, 0, 6, 5, 2)], pa.large_binary())).tolist() == [7, 0, 3, 0, 6, 5, 2]


def test_bits_that_units_share_are_walked_once():
    """A unit took a step for each of its bits in every pass; what units share from
    their start is now one step, with the same counts and scores."""
    rng = random.Random(9)
    keys = list({rng.choice([b"", bitmix.CUT]) + b"pre" + bytes(rng.choices(b"ab\0", k=rng.randint(0, 9))) + rng.choice([b" ", b"\n", b"\xff"]) for _ in range(400)})
    counts = np.array([rng.choice([0, 1, 40]) for _ in keys])
    units, paths = bitmix.Units(keys, counts), bitmix.Paths(keys, counts)
    whole = [f"{k[0] == 0xfd}" + "".join(f"{x:08b}" for x in k.removeprefix(bitmix.CUT)) for k in keys]
    edges = {w[:i] for w in whole for i in range(len(w) - len(w.lstrip("TrueFalse")) + 8 * bitmix.FIRST + 1, len(w) + 1)}
    walked = sum(len(lead) for _, _, lead, *_ in paths.walk())
    assert walked == len(edges) < sum(n for n, *_ in units.walk()) / 2
    plain = [*bitmix.new_global(), *bitmix.new_local()]
    bitmix.learn_counts(units, plain)
    low, prefixes = bitmix.new_global(), bitmix.new_local()
    bitmix.learn_low_counts(bitmix.Grams(keys, counts), low)
    bitmix.learn_prefix_counts(paths, prefixes)
    assert all((a == b).all() for a, b in zip(plain, [*low, *prefixes], strict=True))
    weights, refine = bitmix.new_weights(), np.zeros((256, bitmix.CELLS, 2))
    bitmix.learn_weights(units, plain, weights, np.zeros_like(weights), refine)
    model = bitmix.Scorer(plain, weights, refine)
    assert (model.log_probability(paths) == model.log_probability(units)).all()
    assert len(model.log_probability(bitmix.Paths([], np.zeros(0)))) == 0


def test_prefix_counts_do_not_depend_on_the_dealing(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "GROUP_UNITS", 4)
    monkeypatch.setattr(lm_scoring, "PART_UNITS", 4)
    rng = random.Random(5)
    found = {b"https://www." + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 4))) + b" " for _ in range(60)}
    found |= {bitmix.CUT + b"https" + bytes(rng.choice(b"abc") for _ in range(3)) + b"\xff" for _ in range(40)}
    found |= {b"htt ", b"http ", b"ab ", b"a ", b"htt", b"x" * 63}
    counts = {k: rng.choice([0, 1, 2, 70]) for k in sorted(found)}
    units = spark.createDataFrame([(bytearray(k), n) for k, n in counts.items()], "key binary, train long")
    true = Counter()
    for k, n in counts.items():
        kind, k = k[:1] == bitmix.CUT, k.removeprefix(bitmix.CUT)
        for t, byte in enumerate(k):
            for b in range(8):
                true[kind, k[:t], (256 | byte) >> (8 - b), byte >> (7 - b) & 1] += n
    dealing = lm_scoring._hot(units)
    assert max(map(len, dealing[0])) >= 12  # deeper than any prefix that units are dealt by as a rule
    after = lm_scoring._after_hot(units, dealing[0])

    def parts(batches):
        keys, n = lm_scoring._gathered(batches)
        yield pa.RecordBatch.from_arrays([pa.array([keys], pa.list_(pa.binary())), pa.array([n.tolist()], pa.list_(pa.int64()))], names=["k", "n"])
    got = [r for r in lm_scoring._partitions(units, dealing).mapInArrow(parts, "k array<binary>, n array<long>").collect() if r.k]
    assert len(got) > 2 and sorted(bytes(k) for r in got for k in r.k) == sorted(counts)
    for r in got:
        keys = [bytes(k) for k in r.k]
        table = lm_scoring._tables([], keys, np.array(r.n), after, 26)[-1]  # few slots are shared by chance
        u = bitmix.Units(keys, np.array(r.n), 26)
        names = [keys[i] for i in u.order]
        for i, (n, _, node, slots) in enumerate(u.walk()):
            for j in range(n if bitmix.FIRST + i // 8 >= bitmix.LOCAL_FROM else 0):
                kind, k = names[j][:1] == bitmix.CUT, names[j].removeprefix(bitmix.CUT)
                assert table[slots[3][j]].tolist() == [true[kind, k[:bitmix.FIRST + i // 8], int(node[j]), b] for b in (0, 1)]


def test_prefix_tables_grow_with_the_units():
    assert [bitmix.local_bits(n) for n in (0, 1 << 18, (1 << 18) + 1, 1 << 20)] == [22, 22, 23, 24]


def test_every_training_unit_takes_part_in_learning_weights(spark):
    counts = {b"u%03d " % i: (0, 1, 2, 300)[i % 4] for i in range(200)}
    units = spark.createDataFrame([(bytearray(k), n) for k, n in counts.items()], "key binary, train long")
    send = spark.sparkContext.broadcast
    weights, refine = lm_scoring._mixer(units, send(bitmix.new_global()), send({}), (frozenset(), 3))
    assert refine[1].sum() == sum((len(k) - bitmix.FIRST) * n for k, n in counts.items())  # first bit of each byte that units predict, by training count
    assert np.isfinite(weights).all()


def test_svg_without_an_end_tag_keeps_the_rest_of_the_page():
    for svg in ("<svg viewBox='0 0 1 1'/>", "<svg/>", "<svg a />", "<svg a=b/>", "<svg><path d='M0'/>", "<template>"):
        assert [b.text for b in blocks(f"<p>one</p>{svg}<p>two</p>")] == ["one", "two"], svg
    assert [b.text for b in blocks("<p>one<svg/> two</p><p>three<svg><text>in</text></svg> four</p>")] == ["one two", "three four"]
    assert [b.text for b in blocks("<p>one</p><svg a=b/><text>in</text></svg><p>two</p>")] == ["one", "two"]
    assert [b.text for b in blocks("<p>one</p><script>x <p>two</p>")] == ["one"]
