"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark plans: global window functions, recursive
CTEs and list lambdas, over the same driver tables. Constants are stated here
again, so that a wrong one in the library shows.
"""

from __future__ import annotations

from types import SimpleNamespace

# The settings of the registered queries.
OPTS = SimpleNamespace(seq_len=480, batch_size=6, num_epochs=10, train_fraction=0.9, label_smoothing=0.1, val_examples=2,
                       src_lang="en", artifact_folder="opus100_weights", model_basename="tmodel_")
SEED, PREVIEW_ROWS, CHECK_SEQ_LEN, MASK_SEQ_LEN, LOOP_LEN, CLASSES = 42, 5, 128, 64, 8, 32
T = SimpleNamespace(POSITIONS_PER_EXAMPLE=8, SCORE_PAD=0, STEPS_PER_EPOCH=1000, TRAIN_TAG="click", VAL_TAG="view", BATCHES=50)
# Python's str.split() white space: everything RE2 calls \s or a separator, and U+001C-U+001F, U+0085.
WHITESPACE_RUN = r"[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}]+"
TURN = 2147483648  # ids of one conversation

L = OPTS.seq_len
BIG = 1_000_000_000


def words(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '{WHITESPACE_RUN}'), lambda x: x <> '')"


def chars(expr: str) -> str:
    return f"regexp_extract_all({expr}, '(?s).')"


PAIRS = f"""pairs AS (
  SELECT CAST(u.conv_id::BIGINT * {TURN} + u.turn AS BIGINT) AS pair_id, u.text AS src_text, a.text AS trg_text
  FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

EV = PAIRS + """,
ev AS (SELECT pair_id, src_text AS source, trg_text AS expected,
              CASE WHEN pair_id % 2147483648 % 3 <> 2 THEN src_text ELSE '' END AS predicted FROM pairs)"""

SPECIALS = """specials AS (SELECT token, CAST(id AS INTEGER) AS id, CAST(n AS BIGINT) AS n, is_special
  FROM (VALUES ('[UNK]', 0, 0, true), ('[PAD]', 1, 0, true), ('[SOS]', 2, 0, true), ('[EOS]', 3, 0, true))
  t(token, id, n, is_special))"""


def vocab_cte(name: str, texts_sql: str, tok: str = "word") -> str:
    split = words("text") if tok == "word" else chars("text")
    return f"""{name}_counts AS (
  SELECT token, count(*) AS n FROM (SELECT unnest({split}) AS token FROM ({texts_sql}))
  GROUP BY token HAVING token NOT IN ('[UNK]', '[PAD]', '[SOS]', '[EOS]')),
{name} AS (
  SELECT * FROM specials
  UNION ALL
  SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 3 AS INTEGER), CAST(n AS BIGINT), false
  FROM {name}_counts)"""


def encode_cte(name: str, vocab: str, tok: str = "word") -> str:
    split = words if tok == "word" else chars
    return f"""{name}_toks AS (
  SELECT pair_id, side, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM (
    SELECT pair_id, 0 AS side, {split('src_text')} AS w FROM pairs
    UNION ALL SELECT pair_id, 1 AS side, {split('trg_text')} AS w FROM pairs)),
{name}_agg AS (
  SELECT t.pair_id,
         list(coalesce(v.id, 0) ORDER BY t.pos) FILTER (WHERE t.side = 0) AS src_ids,
         list(coalesce(v.id, 0) ORDER BY t.pos) FILTER (WHERE t.side = 1) AS trg_ids
  FROM {name}_toks t LEFT JOIN {vocab} v ON v.token = t.token AND NOT v.is_special GROUP BY t.pair_id),
{name} AS (
  SELECT p.pair_id, p.src_text, p.trg_text,
         CAST(coalesce(a.src_ids, []) AS INTEGER[]) AS src_ids,
         CAST(coalesce(a.trg_ids, []) AS INTEGER[]) AS trg_ids
  FROM pairs p LEFT JOIN {name}_agg a USING (pair_id))"""


SRC_VOCAB = vocab_cte("vocab", "SELECT src_text AS text FROM pairs")
BOTH_TEXTS = "SELECT src_text AS text FROM pairs UNION ALL SELECT trg_text FROM pairs"
SHARED_VOCAB = vocab_cte("svocab", BOTH_TEXTS)
SHARED = f"WITH {PAIRS},\n{SPECIALS},\n{SHARED_VOCAB},\n{encode_cte('enc', 'svocab')}"


def pads(n: str) -> str:
    return f"list_transform(range({n}), lambda x: 1)"


REASON = """CASE WHEN src_text IS NULL OR trg_text IS NULL THEN 'null_text' WHEN len(src_ids) > {0} - 2 THEN 'src_too_long'
              WHEN len(trg_ids) > {0} - 1 THEN 'trg_too_long' END"""


def examples_cte(n: int) -> str:
    return f""",
exr AS (SELECT *, {REASON.format(n)} AS reason FROM enc),
ex AS (
  SELECT pair_id, src_text, trg_text, reason,
         CASE WHEN reason IS NULL THEN [2] || src_ids || [3] || {pads(f'{n} - len(src_ids) - 2')} END AS encoder_input,
         CASE WHEN reason IS NULL THEN [2] || trg_ids || {pads(f'{n} - len(trg_ids) - 1')} END AS decoder_input,
         CASE WHEN reason IS NULL THEN trg_ids || [3] || {pads(f'{n} - len(trg_ids) - 1')} END AS label
  FROM exr),
exm AS (
  SELECT *, list_transform(encoder_input, lambda x: CASE WHEN x <> 1 THEN 1 ELSE 0 END) AS encoder_mask,
         list_transform(decoder_input, lambda x: CASE WHEN x <> 1 THEN 1 ELSE 0 END) AS dec_valid
  FROM ex)"""


EXAMPLES = SHARED + examples_cte(L)


def rs(col: str) -> str:
    return f"array_to_string({col}, ',') AS {col}"


SPLIT = f"""{PAIRS},
sp AS (
  SELECT pair_id,
         row_number() OVER (ORDER BY md5(CAST(pair_id AS VARCHAR) || '|{SEED}'), pair_id) AS split_rank,
         count(*) OVER () AS total
  FROM pairs),
split AS (
  SELECT pair_id, split_rank,
         CASE WHEN split_rank <= floor({OPTS.train_fraction}::DOUBLE * total) THEN 'train' ELSE 'val' END AS split
  FROM sp)"""


def ranked_cte(split_name: str, epochs: str) -> str:
    return f"""ranked AS (
  SELECT pair_id, CAST(e.epoch AS INTEGER) AS epoch,
         row_number() OVER (PARTITION BY e.epoch ORDER BY
             md5(CAST(pair_id AS VARCHAR) || '|{SEED}|' || CAST(e.epoch AS VARCHAR)), pair_id) AS rank,
         count(*) OVER (PARTITION BY e.epoch) AS epoch_rows
  FROM (SELECT pair_id FROM split WHERE split = '{split_name}'), (SELECT unnest({epochs}) AS epoch) e)"""


TRAIN_RANKED = f"WITH {SPLIT},\n{ranked_cte('train', f'range({OPTS.num_epochs})')}"
B = OPTS.batch_size

SCORES = f"""sc AS (
  SELECT vec_id, CAST(vec_id // {T.POSITIONS_PER_EXAMPLE} AS BIGINT) AS example_id, label, x,
         m + ln(list_sum(list_transform(x, lambda v: exp(v - m)))) AS lse
  FROM (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x,
               list_max(list_transform(embedding, lambda v: CAST(v AS DOUBLE))) AS m FROM embeddings))"""

NLL = "(lse - x[label + 1])"
SMOOTH = f"(lse - list_sum(x) / len(x))"
EPS = OPTS.label_smoothing

WER_DP = f"""w AS (SELECT pair_id, {words('predicted')} AS h, {words('expected')} AS r FROM ev),
dp AS (
  SELECT pair_id, h, r, len(h) AS n, len(r) AS m, 0 AS d,
         list_transform(range(len(h) + 1), lambda i: {BIG}) AS p2,
         list_transform(range(len(h) + 1), lambda i: CASE WHEN i = 0 THEN 0 ELSE {BIG} END) AS p1
  FROM w
  UNION ALL
  SELECT pair_id, h, r, n, m, d + 1, p1,
         list_transform(range(n + 1), lambda i: CASE
             WHEN d + 1 - i < 0 OR d + 1 - i > m THEN {BIG}
             WHEN i = 0 THEN d + 1
             WHEN d + 1 - i = 0 THEN i
             ELSE least(p1[i] + 1, p1[i + 1] + 1,
                        p2[i] + CASE WHEN h[i] = r[d + 1 - i] THEN 0 ELSE 1 END) END)
  FROM dp WHERE d < n + m)"""

NGRAMS = f"""g AS (
  SELECT pair_id, side, n,
         list_transform(range(1, len(t) - n + 2), lambda i: array_to_string(t[i:i + n - 1], ' ')) AS grams
  FROM (SELECT pair_id, 0 AS side, {words('predicted')} AS t FROM ev
        UNION ALL SELECT pair_id, 1 AS side, {words('expected')} AS t FROM ev),
       (SELECT unnest([1, 2, 3, 4]) AS n)),
gc AS (
  SELECT pair_id, n, gram, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS hc,
         sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS rc
  FROM (SELECT pair_id, n, side, unnest(grams) AS gram FROM g) GROUP BY pair_id, n, gram),
st AS (
  SELECT CAST(n AS INTEGER) AS n, CAST(sum(least(hc, rc)) AS BIGINT) AS matches,
         CAST(sum(hc) AS BIGINT) AS candidates
  FROM gc GROUP BY n)"""

def cls(ids: str) -> str:
    """Source class: the ids with [SOS] and [EOS], summed."""
    return f"CAST((2 + 3 + coalesce(list_sum({ids}), 0)) % {CLASSES} AS INTEGER)"


def bigram(where: str = "") -> str:
    """Best next id by class and last id; every last id is given every class, the
    classes that never saw it by the counts of all."""
    return f"""bg AS (
  SELECT c, seq[i] AS prev_id, seq[i + 1] AS next_id, count(*) AS score
  FROM (SELECT c, seq, unnest(range(1, len(seq))) AS i
        FROM (SELECT {cls('src_ids')} AS c, [2] || trg_ids || [3] AS seq FROM enc {where}))
  GROUP BY ALL),
own AS (SELECT c, prev_id, next_id FROM bg
        QUALIFY row_number() OVER (PARTITION BY c, prev_id ORDER BY score DESC, next_id) = 1),
every AS (SELECT prev_id, next_id FROM (SELECT prev_id, next_id, sum(score) AS score FROM bg GROUP BY ALL)
          QUALIFY row_number() OVER (PARTITION BY prev_id ORDER BY score DESC, next_id) = 1),
best AS (SELECT k.c, e.prev_id, coalesce(o.next_id, e.next_id) AS next_id
         FROM every e CROSS JOIN (SELECT unnest(range({CLASSES})) AS c) k
         LEFT JOIN own o ON o.c = k.c AND o.prev_id = e.prev_id)"""


BIGRAM = bigram()


def decode_rec(n: int = L) -> str:
    """What each class decodes to from [SOS]."""
    return f"""dec AS (
  SELECT k AS c, [2] AS ids, false AS done FROM (SELECT unnest(range({CLASSES})) AS k)
  UNION ALL
  SELECT d.c, d.ids || [b.next_id], (b.next_id = 3 OR len(d.ids) + 1 >= {n})
  FROM dec d JOIN best b ON b.prev_id = d.ids[-1] AND b.c = d.c WHERE NOT d.done),
decoded AS (SELECT c, arg_max(ids, len(ids)) AS ids, max(len(ids)) - 1 AS steps FROM dec GROUP BY c)"""


def decoded_pairs(n: int) -> str:
    return f"""{SHARED.replace('WITH ', 'WITH RECURSIVE ', 1)},
{BIGRAM},
{decode_rec(n)},
r AS (SELECT *, {cls('src_ids')} AS c, CASE WHEN len(src_ids) > {L} - 2 THEN 'src_too_long'
                                            WHEN len(trg_ids) > {L} - 1 THEN 'trg_too_long' END AS reason FROM enc)
SELECT r.pair_id, CASE WHEN reason IS NULL THEN array_to_string(d.ids, ',') END AS ids,
       CASE WHEN reason IS NULL THEN CAST(d.steps AS INTEGER) END AS steps, reason
FROM r JOIN decoded d ON d.c = r.c"""


ROUTING = f"""inp AS (
  SELECT CAST(conv_id::BIGINT * {TURN} + turn AS BIGINT) AS input_id,
         CASE WHEN role = 'user' THEN CAST(conv_id::BIGINT * {TURN} + turn AS VARCHAR) ELSE text END AS input
  FROM conversations),
routed AS (
  SELECT i.input_id, i.input, regexp_full_match(i.input, '[0-9]+') AS is_row_id,
         CASE WHEN regexp_full_match(i.input, '[0-9]+') THEN p.src_text ELSE i.input END AS source,
         CASE WHEN regexp_full_match(i.input, '[0-9]+') THEN p.trg_text ELSE '' END AS expected,
         (NOT regexp_full_match(i.input, '[0-9]+') OR p.src_text IS NOT NULL) AS found
  FROM inp i LEFT JOIN pairs p
    ON regexp_full_match(i.input, '[0-9]+') AND p.pair_id = TRY_CAST(i.input AS BIGINT))"""

METRIC = """ml AS (SELECT CAST(user_id % 7 AS VARCHAR) AS run, event_type AS tag, CAST(event_id AS BIGINT) AS step,
  CAST(value AS DOUBLE) AS value, ts FROM events),
lps AS (SELECT run, tag, step, arg_max(value, ts) AS value FROM ml GROUP BY run, tag, step)"""

ARTIFACTS = f"""art AS (
  SELECT event_type AS run, CAST(user_id AS INTEGER) AS epoch, CAST(event_id AS BIGINT) AS global_step,
         printf('{OPTS.artifact_folder}/{OPTS.model_basename}%02d.pt', CAST(user_id AS INTEGER)) AS path
  FROM events),
latest AS (
  SELECT run, epoch, global_step, path FROM (
    SELECT *, row_number() OVER (PARTITION BY run ORDER BY epoch DESC, global_step DESC) AS rk FROM art)
  WHERE rk = 1)"""

SPE = T.STEPS_PER_EPOCH
VAL_CURVE = f"""vc AS (
  SELECT run, CAST(floor((step - 1) / {SPE}) AS BIGINT) AS epoch, arg_max(value, step) AS val_loss
  FROM lps WHERE tag = '{T.VAL_TAG}' GROUP BY 1, 2)"""


ROUNDS = 3  # of expectation-maximisation


def _round(k: int) -> str:
    """Shares of every link under the table before, and the table they make."""
    weight, source = ("ns", "lnk") if k == 0 else ("ns * p", f"lnk JOIN p{k - 1} USING (s, t)")
    return f"""e{k} AS (SELECT s, t, sum(nt * w / d) AS c FROM (
  SELECT s, t, nt, {weight} AS w, sum({weight}) OVER (PARTITION BY pair_id, t) AS d FROM {source}) GROUP BY ALL),
p{k} AS (SELECT s, t, c / sum(c) OVER (PARTITION BY s) AS p FROM e{k})"""


EM = f"""lnk AS (SELECT pair_id, s, t, a.n AS ns, b.n AS nt FROM (
    SELECT pair_id, s, count(*) AS n FROM (SELECT pair_id, unnest(src_ids) AS s FROM enc) GROUP BY ALL
    UNION ALL SELECT pair_id, -1, 1 FROM enc) a
  JOIN (SELECT pair_id, t, count(*) AS n FROM (SELECT pair_id, unnest(trg_ids) AS t FROM enc) GROUP BY ALL) b USING (pair_id)),
{(',' + chr(10)).join(_round(k) for k in range(ROUNDS))},
tr_best AS (SELECT s, t, p FROM p{ROUNDS - 1} WHERE s <> -1
            QUALIFY row_number() OVER (PARTITION BY s ORDER BY round(ln(p), 9) DESC, t) = 1)"""

TRANSLATE = f"""{SHARED},
{EM},
{ROUTING},
rid AS (SELECT *, row_number() OVER () AS rid FROM routed),
stok AS (SELECT rid, pos, coalesce(v.id, 0) AS id FROM (
           SELECT rid, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM (SELECT rid, {words('source')} AS w FROM rid)) s
         LEFT JOIN svocab v ON v.token = s.token AND NOT v.is_special),
said AS (SELECT rid, count(*) AS n, string_agg(coalesce(v.token, '[UNK]'), ' ' ORDER BY pos) AS words
         FROM stok LEFT JOIN tr_best b ON b.s = stok.id LEFT JOIN svocab v ON v.id = coalesce(b.t, stok.id) GROUP BY rid),
tr AS (
  SELECT input_id, input, is_row_id, found, source, expected,
         CASE WHEN found AND NOT too_long THEN '[SOS] ' || generated END AS predicted,
         CASE WHEN found AND NOT too_long THEN generated END AS generated,
         CASE WHEN NOT found THEN 'unknown_id' WHEN too_long THEN 'src_too_long' END AS reason
  FROM (SELECT r.*, coalesce(n, 0) > {L - 2} AS too_long, coalesce(words || ' ', '') || '[EOS]' AS generated
        FROM rid r LEFT JOIN said USING (rid)))"""


NGRAMS_DECODED = f"""{SHARED.replace('WITH ', 'WITH RECURSIVE ', 1)},
seqs AS (SELECT [2] || trg_ids || [3] AS s FROM enc),
grams AS (SELECT s[i - k:i - 1] AS ctx, s[i] AS next_id, count(*) AS n
          FROM (SELECT s, unnest(range(2, len(s) + 1)) AS i FROM seqs), (SELECT unnest([1, 2, 3]) AS k) WHERE i > k GROUP BY ALL
          UNION ALL SELECT [], s[i], count(*) FROM (SELECT s, unnest(range(2, len(s) + 1)) AS i FROM seqs) GROUP BY 2),
best AS (SELECT array_to_string(ctx, ',') AS ctx, next_id FROM grams
         QUALIFY row_number() OVER (PARTITION BY ctx ORDER BY n DESC, next_id) = 1),
start AS (SELECT DISTINCT [2] || trg_ids[1:2] AS ids FROM enc),
dec AS (
  SELECT ids AS head, ids, len(ids) >= {L} AS done FROM start
  UNION ALL
  SELECT head, ids || [next_id], next_id = 3 OR len(ids) + 1 >= {L}
  FROM (SELECT head, ids, coalesce(b3.next_id, b2.next_id, b1.next_id, b0.next_id) AS next_id FROM dec
        LEFT JOIN best b3 ON len(ids) >= 3 AND b3.ctx = array_to_string(ids[-3:], ',')
        LEFT JOIN best b2 ON len(ids) >= 2 AND b2.ctx = array_to_string(ids[-2:], ',')
        LEFT JOIN best b1 ON b1.ctx = array_to_string(ids[-1:], ',')
        LEFT JOIN best b0 ON b0.ctx = '' WHERE NOT done)),
full_ AS (SELECT head, arg_max(ids, len(ids)) AS ids FROM dec GROUP BY head)
SELECT pair_id, array_to_string(f.ids, ',') AS ids, CAST(len(f.ids) - len(f.head) AS INTEGER) AS steps
FROM enc JOIN full_ f ON f.head = [2] || trg_ids[1:2]"""


CER_SUMS = f"""cs AS (
  SELECT sum(levenshtein(array_to_string(list_transform(h, lambda x: chr(list_position(a, x))), ''),
                         array_to_string(list_transform(r, lambda x: chr(list_position(a, x))), ''))) AS edits,
         sum(nr) AS total
  FROM (SELECT h, r, nr, list_distinct(h || r) AS a FROM (
        SELECT {chars('predicted')} AS h, {chars('expected')} AS r, length(expected) AS nr FROM ev)))"""

BLEU_ROW = f"""bl AS (
  SELECT CASE WHEN (SELECT count(*) FROM st) < 4 OR (SELECT min(matches) FROM st) = 0 THEN 0.0
              ELSE (CASE WHEN hyp_len > ref_len THEN 1.0 ELSE exp(1 - ref_len / hyp_len) END)
                   * exp((SELECT sum(ln(matches / candidates) / 4) FROM st)) END AS bleu
  FROM (SELECT sum(len({words('predicted')})) AS hyp_len, sum(len({words('expected')})) AS ref_len FROM ev))"""

VALIDATION = f"""{SHARED.replace('WITH ', 'WITH RECURSIVE ', 1)},
{SPLIT.replace(PAIRS + ',', '', 1)},
{bigram("WHERE pair_id IN (SELECT pair_id FROM split WHERE split = 'train')")},
{decode_rec()},
chain AS (SELECT c, string_agg(coalesce(v.token, '[UNK]'), ' ' ORDER BY t.pos) AS text
          FROM (SELECT c, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM decoded) t
          LEFT JOIN svocab v ON v.id = t.id GROUP BY c),
ev AS (SELECT pair_id, trg_text AS expected, CASE WHEN len(src_ids) <= {L - 2} THEN chain.text ELSE '' END AS predicted
       FROM enc JOIN chain ON chain.c = {cls('src_ids')}
       WHERE pair_id IN (SELECT pair_id FROM split WHERE split = 'val')),
{WER_DP},
fin AS (SELECT p1[n + 1] AS edits, m FROM dp WHERE d = n + m),
{NGRAMS},
{CER_SUMS},
{BLEU_ROW}"""


BY_TURN = f"""{EV.replace("ev AS (SELECT pair_id,", "ev AS (SELECT pair_id, CAST(pair_id % 2147483648 AS INTEGER) AS turn,", 1)},
{WER_DP},
wt AS (SELECT e.turn, sum(f.edits) AS edits, sum(f.m) AS total
       FROM (SELECT pair_id, p1[n + 1] AS edits, m FROM dp WHERE d = n + m) f JOIN ev e USING (pair_id)
       GROUP BY e.turn),
ct AS (SELECT turn,
              sum(levenshtein(array_to_string(list_transform(h, lambda x: chr(list_position(a, x))), ''),
                              array_to_string(list_transform(r, lambda x: chr(list_position(a, x))), ''))) AS edits,
              sum(nr) AS total
       FROM (SELECT turn, h, r, nr, list_distinct(h || r) AS a FROM (
             SELECT turn, {chars('predicted')} AS h, {chars('expected')} AS r, length(expected) AS nr FROM ev))
       GROUP BY turn),
gt AS (
  SELECT turn, n, list_transform(range(1, len(t) - n + 2), lambda i: array_to_string(t[i:i + n - 1], ' ')) AS grams,
         side, pair_id
  FROM (SELECT pair_id, turn, 0 AS side, {words('predicted')} AS t FROM ev
        UNION ALL SELECT pair_id, turn, 1 AS side, {words('expected')} AS t FROM ev),
       (SELECT unnest([1, 2, 3, 4]) AS n)),
gct AS (SELECT turn, pair_id, n, gram, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS hc,
               sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS rc
        FROM (SELECT turn, pair_id, n, side, unnest(grams) AS gram FROM gt) GROUP BY turn, pair_id, n, gram),
stt AS (SELECT turn, n, sum(least(hc, rc)) AS matches, sum(hc) AS candidates FROM gct GROUP BY turn, n),
lt AS (SELECT turn, sum(len({words('predicted')})) AS hyp_len, sum(len({words('expected')})) AS ref_len
       FROM ev GROUP BY turn),
bt AS (SELECT l.turn,
              CASE WHEN coalesce(s.orders, 0) < 4 OR s.min_match = 0 THEN 0.0
                   ELSE (CASE WHEN l.hyp_len > l.ref_len THEN 1.0 ELSE exp(1 - l.ref_len / l.hyp_len) END)
                        * exp(s.log_p) END AS bleu
       FROM lt l LEFT JOIN (SELECT turn, count(*) AS orders, min(matches) AS min_match,
                                   sum(ln(matches / candidates) / 4) AS log_p FROM stt GROUP BY turn) s USING (turn))"""


def _quarantine(seq_len: int) -> str:
    return f"""WITH {PAIRS}
SELECT pair_id, CAST(len({words('src_text')}) AS BIGINT) AS n_src, CAST(len({words('trg_text')}) AS BIGINT) AS n_trg,
       CASE WHEN src_text IS NULL OR trg_text IS NULL THEN 'null_text'
            WHEN len({words('src_text')}) > {seq_len - 2} THEN 'src_too_long'
            WHEN len({words('trg_text')}) > {seq_len - 1} THEN 'trg_too_long' END AS reason
FROM pairs"""


def _examples_col(col: str) -> str:
    return f"{EXAMPLES}\nSELECT pair_id, {rs(col)} FROM exm"


ORACLE: dict[str, str] = {
    "pairs_load": f"WITH {PAIRS} SELECT pair_id, src_text, trg_text, CASE WHEN pair_id % 10 = 0 THEN 'test' ELSE 'train' END AS split FROM pairs",
    "pairs_load_split": f"WITH {PAIRS} SELECT pair_id, src_text, trg_text, 'test' AS split FROM pairs WHERE pair_id % 10 = 0",
    "pairs_count": f"WITH {PAIRS} SELECT CAST(count(*) AS BIGINT) AS n_pairs FROM pairs",
    "pair_preview": f"WITH {PAIRS} SELECT pair_id, src_text, trg_text FROM pairs ORDER BY pair_id LIMIT {PREVIEW_ROWS}",
    "pair_lookup": f"""WITH {PAIRS}
SELECT i.pair_id, p.src_text, p.trg_text, p.src_text IS NOT NULL AS found
FROM (SELECT CAST(conv_id::BIGINT * {TURN} + turn AS BIGINT) AS pair_id FROM conversations) i
LEFT JOIN pairs p USING (pair_id)""",
    "pair_positions": f"""WITH {PAIRS}
SELECT CAST(row_number() OVER (ORDER BY pair_id) - 1 AS BIGINT) AS position, pair_id, src_text, trg_text FROM pairs""",
    "input_routing": f"WITH {PAIRS},\n{ROUTING}\nSELECT * FROM routed",
    "sentences_lang": f"SELECT doc_id AS id, text AS sentence FROM documents WHERE lang = '{OPTS.src_lang}'",
    "vocab_build": f"WITH {PAIRS},\n{SPECIALS},\n{SRC_VOCAB}\nSELECT token, id, n, is_special FROM vocab",
    "vocab_by_lang": f"""WITH {SPECIALS},
c AS (SELECT lang, token, count(*) AS n FROM (SELECT lang, unnest({words('text')}) AS token FROM documents)
      GROUP BY lang, token HAVING token NOT IN ('[UNK]', '[PAD]', '[SOS]', '[EOS]'))
SELECT l.lang, s.token, s.id, s.n, s.is_special FROM (SELECT DISTINCT lang FROM documents) l, specials s
UNION ALL
SELECT lang, token, CAST(row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) + 3 AS INTEGER) AS id,
       CAST(n AS BIGINT) AS n, false AS is_special FROM c""",
    "special_ids": """SELECT DISTINCT lang, token, CAST(id AS INTEGER) AS id FROM documents,
       (VALUES ('[UNK]', 0), ('[PAD]', 1), ('[SOS]', 2), ('[EOS]', 3)) t(token, id)""",
    "vocab_store": f"WITH {PAIRS},\n{SPECIALS},\n{vocab_cte('tvocab', 'SELECT trg_text AS text FROM pairs')}\n"
                   "SELECT token, id, n, is_special FROM tvocab",
    "vocab_size": f"WITH {PAIRS},\n{SPECIALS},\n{SRC_VOCAB}\nSELECT CAST(count(*) AS BIGINT) AS vocab_size FROM vocab",
    "encode_word": f"{SHARED}\nSELECT pair_id, {rs('src_ids')}, {rs('trg_ids')} FROM enc",
    "encode_two_vocabs": f"WITH {PAIRS},\n{SPECIALS},\n{SRC_VOCAB},\n{vocab_cte('tvocab', 'SELECT trg_text AS text FROM pairs')},\n"
                         f"{encode_cte('es', 'vocab')},\n{encode_cte('et', 'tvocab')}\n"
                         "SELECT es.pair_id, array_to_string(es.src_ids, ',') AS src_ids, array_to_string(et.trg_ids, ',') AS trg_ids "
                         "FROM es JOIN et USING (pair_id)",
    "encode_by_lang": f"""WITH c AS (
  SELECT lang, token, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, token) + 3 AS id
  FROM (SELECT lang, unnest({words('text')}) AS token FROM documents)
  WHERE token NOT IN ('[UNK]', '[PAD]', '[SOS]', '[EOS]') GROUP BY lang, token),
t AS (SELECT doc_id, lang, unnest(w) AS token, generate_subscripts(w, 1) AS pos
      FROM (SELECT doc_id, lang, {words('text')} AS w FROM documents))
SELECT d.doc_id, coalesce(string_agg(CAST(coalesce(c.id, 0) AS VARCHAR), ',' ORDER BY t.pos) FILTER (t.pos IS NOT NULL), '') AS ids
FROM documents d LEFT JOIN t USING (doc_id) LEFT JOIN c ON c.lang = t.lang AND c.token = t.token GROUP BY d.doc_id""",
    "encode_char": f"WITH {PAIRS},\n{SPECIALS},\n"
                   f"{vocab_cte('cvocab', BOTH_TEXTS, 'char')},\n"
                   f"{encode_cte('enc', 'cvocab', 'char')}\n"
                   f"SELECT pair_id, {rs('src_ids')}, {rs('trg_ids')} FROM enc",
    # every word of both sides is in the vocabulary (a literal special string is not looked up)
    "decode_roundtrip": f"""WITH {PAIRS},
u AS (SELECT pair_id, list_transform({words('src_text')}, lambda x: CASE WHEN x IN ('[UNK]', '[PAD]', '[SOS]', '[EOS]') THEN '[UNK]' ELSE x END) AS s,
             list_transform({words('trg_text')}, lambda x: CASE WHEN x IN ('[UNK]', '[PAD]', '[SOS]', '[EOS]') THEN '[UNK]' ELSE x END) AS t FROM pairs)
SELECT pair_id, array_to_string(s, ' ') AS src_back, array_to_string(t, ' ') AS trg_back FROM u""",
    "token_lengths": f"WITH {PAIRS} SELECT pair_id, CAST(len({words('src_text')}) AS BIGINT) AS n_src, "
                     f"CAST(len({words('trg_text')}) AS BIGINT) AS n_trg FROM pairs",
    "max_lengths": f"WITH {PAIRS} SELECT CAST(max(len({words('src_text')})) AS BIGINT) AS max_src, "
                   f"CAST(max(len({words('trg_text')})) AS BIGINT) AS max_trg FROM pairs",
    "length_quarantine": _quarantine(L),
    "length_quarantine_128": _quarantine(CHECK_SEQ_LEN),
    "examples": f"{EXAMPLES}\nSELECT pair_id, {rs('encoder_input')}, {rs('decoder_input')}, {rs('label')}, "
                f"{rs('encoder_mask')}, {rs('dec_valid')}, src_text, trg_text, reason FROM exm",
    "examples_128": f"{SHARED}{examples_cte(CHECK_SEQ_LEN)}\nSELECT pair_id, {rs('encoder_input')}, {rs('label')}, reason FROM exm",
    "encoder_input": _examples_col("encoder_input"),
    "decoder_input": _examples_col("decoder_input"),
    "label_ids": _examples_col("label"),
    "encoder_mask": _examples_col("encoder_mask"),
    "decoder_mask": f"""{EXAMPLES}
SELECT pair_id, CAST(list_sum(list_transform(range(1, len(dec_valid) + 1), lambda i: list_sum(dec_valid[1:i]))) AS BIGINT) AS cells_set
FROM exm""",
    "decoder_mask_cells": f"""{SHARED}{examples_cte(MASK_SEQ_LEN)}
SELECT pair_id, array_to_string(list_transform(range(1, len(dec_valid) + 1), lambda i: array_to_string(
  list_transform(range(1, len(dec_valid) + 1), lambda j: CASE WHEN dec_valid[j] = 1 AND j <= i THEN 1 ELSE 0 END), '')), ';') AS cells
FROM exm""",
    "example_sizes": f"""{EXAMPLES}
SELECT coalesce(bool_and(len(encoder_input) = {L} AND len(decoder_input) = {L} AND len(label) = {L}), true) AS all_sized,
       CAST(count(encoder_input) AS BIGINT) AS n_examples FROM exm""",
    "split_exact": f"WITH {SPLIT} SELECT pair_id, CAST(split_rank AS BIGINT) AS split_rank, split FROM split",
    "shuffle_rank": f"{TRAIN_RANKED} SELECT pair_id, epoch, CAST(rank AS BIGINT) AS rank FROM ranked",
    "batch_assign": f"{TRAIN_RANKED} SELECT pair_id, epoch, CAST(rank AS BIGINT) AS rank, "
                    f"CAST((rank - 1) // {B} AS BIGINT) AS batch_id FROM ranked",
    "batch_collate": f"""{TRAIN_RANKED}
SELECT epoch, CAST((rank - 1) // {B} AS BIGINT) AS batch_id,
       string_agg(CAST(pair_id AS VARCHAR), ',' ORDER BY rank) AS pair_ids
FROM ranked GROUP BY 1, 2""",
    "epoch_schedule": f"""{TRAIN_RANKED}
SELECT pair_id, epoch, CAST(rank AS BIGINT) AS rank, CAST((rank - 1) // {B} AS BIGINT) AS batch_id,
       CAST(epoch * CAST(ceil(epoch_rows / {B}) AS BIGINT) + (rank - 1) // {B} AS BIGINT) AS global_step
FROM ranked""",
    "train_batches": f"""{SHARED},
{SPLIT.replace(PAIRS + ',', '', 1)}{examples_cte(L)},
fit AS (SELECT e.* FROM exm e JOIN split s USING (pair_id) WHERE s.split = 'train' AND reason IS NULL),
rk AS (SELECT f.*, CAST(e.epoch AS INTEGER) AS epoch, row_number() OVER (PARTITION BY e.epoch ORDER BY
         md5(CAST(pair_id AS VARCHAR) || '|{SEED}|' || CAST(e.epoch AS VARCHAR)), pair_id) AS rank,
         count(*) OVER (PARTITION BY e.epoch) AS n
       FROM fit f, (SELECT unnest(range({OPTS.num_epochs})) AS epoch) e)
SELECT epoch, CAST((rank - 1) // {B} AS BIGINT) AS batch_id,
       CAST(epoch * CAST(ceil(any_value(n) / {B}) AS BIGINT) + (rank - 1) // {B} AS BIGINT) AS global_step,
       string_agg(CAST(pair_id AS VARCHAR), ',' ORDER BY rank) AS pair_ids,
       {', '.join(f"md5(string_agg(array_to_string({f}, ','), ';' ORDER BY rank)) AS {f}" for f in
                  ('encoder_input', 'decoder_input', 'label', 'encoder_mask', 'dec_valid'))}
FROM rk GROUP BY epoch, (rank - 1) // {B}""",
    "val_sample": f"""WITH {SPLIT},
{ranked_cte('val', '[0]')}
SELECT pair_id, CAST(rank AS BIGINT) AS rank FROM ranked ORDER BY rank LIMIT {OPTS.val_examples}""",
    "log_softmax": f"""WITH {SCORES}
SELECT vec_id, CAST(k - 1 AS INTEGER) AS k, round(v - lse, 6) AS log_prob
FROM (SELECT vec_id, lse, unnest(x) AS v, generate_subscripts(x, 1) AS k FROM sc)""",
    "top1_token": "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS top1 FROM embeddings",
    "top1_long": """SELECT vec_id, CAST(token_id AS INTEGER) AS top1 FROM (
  SELECT vec_id, token_id, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, token_id) AS rk
  FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS score, generate_subscripts(embedding, 1) - 1 AS token_id
        FROM embeddings))
WHERE rk = 1""",
    "flatten_scores": f"""SELECT CAST(vec_id // {T.POSITIONS_PER_EXAMPLE} AS BIGINT) AS example_id,
       CAST(row_number() OVER (PARTITION BY vec_id // {T.POSITIONS_PER_EXAMPLE}
            ORDER BY vec_id % {T.POSITIONS_PER_EXAMPLE}) - 1 AS INTEGER) AS pos,
       CAST(label AS INTEGER) AS label,
       CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS top1,
       CAST(len(embedding) AS INTEGER) AS n_classes
FROM embeddings""",
    "masked_ce": f"WITH {SCORES} SELECT round(avg({NLL}), 6) AS loss, CAST(count(*) AS BIGINT) AS n_positions "
                 f"FROM sc WHERE label <> {T.SCORE_PAD}",
    "smoothed_ce": f"WITH {SCORES} SELECT round(avg({1 - EPS} * {NLL} + {EPS} * {SMOOTH}), 6) AS loss, "
                   f"CAST(count(*) AS BIGINT) AS n_positions FROM sc WHERE label <> {T.SCORE_PAD}",
    "mean_val_loss": f"""WITH {SCORES},
pb AS (SELECT example_id, avg({NLL}) AS loss FROM sc WHERE label <> {T.SCORE_PAD} GROUP BY example_id)
SELECT round(coalesce(avg(loss), 0.0), 6) AS mean_loss, CAST(count(*) AS BIGINT) AS n_batches FROM pb""",
    "cer": f"""WITH {EV},
c AS (SELECT {chars('predicted')} AS h, {chars('expected')} AS r, length(expected) AS nr FROM ev),
s AS (SELECT h, r, nr, list_distinct(h || r) AS a FROM c)
SELECT CAST(sum(levenshtein(array_to_string(list_transform(h, lambda x: chr(list_position(a, x))), ''),
                            array_to_string(list_transform(r, lambda x: chr(list_position(a, x))), ''))) AS BIGINT) AS edits,
       CAST(sum(nr) AS BIGINT) AS total,
       round(sum(levenshtein(array_to_string(list_transform(h, lambda x: chr(list_position(a, x))), ''),
                             array_to_string(list_transform(r, lambda x: chr(list_position(a, x))), ''))) / sum(nr), 6) AS cer
FROM s""",
    "wer": f"""WITH RECURSIVE {EV},
{WER_DP},
fin AS (SELECT pair_id, p1[n + 1] AS edits, m FROM dp WHERE d = n + m)
SELECT CAST(sum(edits) AS BIGINT) AS edits, CAST(sum(m) AS BIGINT) AS total, round(sum(edits) / sum(m), 6) AS wer
FROM fin""",
    "bleu_ngrams": f"WITH {EV},\n{NGRAMS}\nSELECT n, matches, candidates FROM st",
    "bleu": f"""WITH {EV},
{NGRAMS},
lens AS (SELECT CAST(sum(len({words('predicted')})) AS BIGINT) AS hyp_len,
                CAST(sum(len({words('expected')})) AS BIGINT) AS ref_len FROM ev)
SELECT round(CASE WHEN (SELECT count(*) FROM st) < 4 OR (SELECT min(matches) FROM st) = 0 THEN 0.0
                  ELSE (CASE WHEN hyp_len > ref_len THEN 1.0 ELSE exp(1 - ref_len / hyp_len) END)
                       * exp((SELECT sum(ln(matches / candidates) / 4) FROM st)) END, 6) AS bleu,
       hyp_len, ref_len FROM lens""",
    "metrics_by_turn": f"""WITH RECURSIVE {BY_TURN}
SELECT c.turn, round(c.edits / c.total, 6) AS cer, round(w.edits / w.total, 6) AS wer, round(b.bleu, 6) AS bleu
FROM ct c JOIN wt w USING (turn) JOIN bt b USING (turn)""",
    "comparison_report": f"""WITH {EV}
SELECT pair_id, CAST(k AS INTEGER) AS line_no, line FROM (
  SELECT pair_id, unnest(['{'-' * 80}', 'SOURCE:' || source, 'TARGET:' || expected, 'PREDICTED:' || predicted]) AS line,
         unnest(range(4)) AS k FROM ev)""",
    "greedy_decode": decoded_pairs(L),
    "decode_loop": decoded_pairs(LOOP_LEN),
    "decode_paths": decoded_pairs(L),
    "decode_ngrams": NGRAMS_DECODED,
    "metric_stream": """SELECT CAST(user_id % 7 AS VARCHAR) AS run, event_type AS tag, CAST(event_id // 50 AS BIGINT) AS step,
       CAST(value AS DOUBLE) AS value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id % 7, event_type, event_id // 50 ORDER BY ts DESC, value DESC) = 1""",
    "causal_mask": f"""{SHARED},
n AS (SELECT max(len(trg_ids)) + 1 AS n FROM enc)
SELECT i, count(*) FILTER (j <= i) AS allowed, max(j) FILTER (j <= i) AS last, count(*) AS cells
FROM n, unnest(range(n)) AS a(i), unnest(range(n)) AS b(j) GROUP BY i""",
    "subword_roundtrip": f"SELECT doc_id, array_to_string({words('text')}, ' ') AS back FROM documents",
    "translation_table": f"{SHARED},\n{EM}\nSELECT s, t, round(p, 6) AS p FROM tr_best",
    "translate_batch": f"""{TRANSLATE}
SELECT input_id, is_row_id, found, predicted, reason FROM tr""",
    "translation_report": f"""{TRANSLATE}
SELECT input_id, CAST(k - 1 AS INTEGER) AS line_no, line FROM (
  SELECT input_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM (
    SELECT input_id, list_filter([
        CASE WHEN is_row_id THEN lpad('ID: ', 12, ' ') || input END,
        lpad('SOURCE: ', 12, ' ') || coalesce(source, ''),
        CASE WHEN is_row_id THEN lpad('TARGET: ', 12, ' ') || coalesce(expected, '') END,
        lpad('PREDICTED: ', 12, ' ') || coalesce(CASE WHEN generated <> '' THEN generated || ' ' END, '')],
        lambda x: x IS NOT NULL) AS ls
    FROM tr))""",
    "validation_metrics": f"""{VALIDATION}
SELECT round((SELECT edits / total FROM cs), 6) AS cer,
       round((SELECT sum(edits) / sum(m) FROM fin), 6) AS wer,
       round((SELECT bleu FROM bl), 6) AS bleu""",
    "artifact_latest": f"WITH {ARTIFACTS} SELECT run, epoch, global_step, path FROM latest",
    "resume_point": f"""WITH {ARTIFACTS}
SELECT r.run, coalesce(l.epoch + 1, 0) AS initial_epoch, coalesce(l.global_step, 0) AS global_step
FROM (SELECT DISTINCT run FROM art) r LEFT JOIN latest l USING (run)""",
    "artifact_log": f"WITH {ARTIFACTS} SELECT run, epoch, global_step, path FROM art",
    "metric_log_by_tag": """SELECT CAST(user_id % 7 AS VARCHAR) AS run, event_type AS tag, CAST(count(*) AS BIGINT) AS n,
       CAST(max(event_id) AS BIGINT) AS last_step, arg_max(value, event_id) AS last_value FROM events GROUP BY 1, 2""",
    "loss_log": f"""WITH {SCORES},
b AS (SELECT example_id, avg({1 - EPS} * {NLL} + {EPS} * {SMOOTH}) AS smooth, avg({NLL}) AS plain
      FROM sc WHERE label <> {T.SCORE_PAD} GROUP BY example_id)
SELECT 'run' AS run, CAST(example_id // {T.BATCHES} AS BIGINT) AS epoch, round(avg(smooth), 6) AS train_loss,
       CAST(count(*) AS BIGINT) AS train_steps, round(avg(plain), 6) AS val_loss FROM b GROUP BY 2""",
    "train_curve": f"WITH {METRIC} SELECT run, step, value FROM lps WHERE tag = '{T.TRAIN_TAG}'",
    "val_curve": f"WITH {METRIC},\n{VAL_CURVE}\nSELECT run, epoch, val_loss FROM vc",
    "loss_curves": f"""WITH {METRIC},
{VAL_CURVE},
tc AS (SELECT run, CAST(floor(step / {SPE}) AS BIGINT) AS epoch, avg(value) AS train_loss, CAST(count(*) AS BIGINT) AS train_steps
       FROM lps WHERE tag = '{T.TRAIN_TAG}' GROUP BY 1, 2)
SELECT tc.run, tc.epoch, round(train_loss, 9) AS train_loss, train_steps, vc.val_loss
FROM tc LEFT JOIN vc USING (run, epoch)""",
}

ORACLE["train_batches_480"] = ORACLE["train_batches"]  # its name when the other one ran at a shorter length
# the preparation job splits by the whole pair, names rows by that rank and shuffles by the name
ORACLE["train_batches_prepared"] = f"""{SHARED}{examples_cte(L)},
sp AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', pair_id, src_text, trg_text, '{SEED}')), pair_id) AS row_id,
              count(*) OVER () AS total FROM exm),
fit AS (SELECT * FROM sp WHERE row_id <= floor({OPTS.train_fraction}::DOUBLE * total) AND reason IS NULL),
rk AS (SELECT f.*, CAST(e.epoch AS INTEGER) AS epoch, row_number() OVER (PARTITION BY e.epoch ORDER BY
         md5(CAST(row_id AS VARCHAR) || '|{SEED}|' || CAST(e.epoch AS VARCHAR)), row_id) AS rank,
         count(*) OVER (PARTITION BY e.epoch) AS n
       FROM fit f, (SELECT unnest(range({OPTS.num_epochs})) AS epoch) e)
SELECT epoch, CAST((rank - 1) // {B} AS BIGINT) AS batch_id,
       CAST(epoch * CAST(ceil(any_value(n) / {B}) AS BIGINT) + (rank - 1) // {B} AS BIGINT) AS global_step,
       string_agg(CAST(pair_id AS VARCHAR), ',' ORDER BY rank) AS pair_ids,
       {', '.join(f"md5(string_agg(array_to_string({f}, ','), ';' ORDER BY rank)) AS {f}" for f in ('encoder_input', 'label'))}
FROM rk GROUP BY epoch, (rank - 1) // {B}"""
for _name in ("log_softmax", "masked_ce", "smoothed_ce"):  # the long forms give the same rows
    ORACLE[f"{_name}_long"] = ORACLE[_name]
