"""Small tables with the awkward cases that every operator must take."""

import random

import duckdb

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "n_words string, kept string, fp string, shard string, epoch string, weight string, spans string, _key string")
CLASH = ("a", "b", "c", "d", "e", "f", "g", "h")


def texts(seed=1):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(400)]

    def prose(n):
        words = [rng.choice(vocab) for _ in range(n)]
        return "".join(w + (".\n" if rng.random() < 0.06 else " ") for w in words).strip()
    passage = prose(70)
    out = [prose(rng.randint(30, 300)) for _ in range(25)]
    out += [f"{prose(20)} {passage} {prose(20)}" for _ in range(6)]
    near = prose(200).split(" ")
    for _ in range(4):
        copy = list(near)
        copy[rng.randrange(len(copy))] = "edited"
        out.append(" ".join(copy))
    out += [out[0]] * 4
    out += ["footer line\n" + prose(40) + "\n  footer line \t"] * 1 + [f"footer line\n{prose(40)}" for _ in range(12)]
    out += ["Schöne Grüße über 日本語 " * 30, "one two three", "\n".join(["the same line again and again"] * 40),
            "# $ % & " * 30 + prose(25), "12 34 56 " * 20, " ".join(w for w in vocab[:30] for _ in range(5)), prose(20_000), "x" * 3000, "aaaa " * 900]
    return out


def rows(seed=1):
    """Documents with NULLs in every column, empty and long texts and repeated rows."""
    got = [(i, t, "en", f"src{i % 9}", len(t)) for i, t in enumerate(texts(seed))]
    got += [(None, "no id at all " * 5, "en", "src1", 5), (900, None, None, None, None), (901, "", "en", "src2", 0),
            (902, " \t\n\r\x0b\x0c ", "en", "src3", 7), (903, "null source here", "en", None, 3), got[3], got[3], (None, None, None, None, None)]
    return [(*r, *CLASH) for r in got]


def documents(spark, folder=None, seed=1, data=None):
    df = spark.createDataFrame(rows(seed) if data is None else data, SCHEMA)
    if folder:
        df.repartition(3).write.parquet(f"{folder}/documents.parquet")
    return df


def benchmark(spark, folder, items):
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{folder}/benchmark.parquet")


def sql(folder, query, tables=("documents",)):
    con = duckdb.connect()
    for t in tables:
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    rel = con.sql(query)
    return sorted(rel.columns), canon(rel.columns, rel.fetchall())


def canon(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in values)


def result(df):
    return sorted(df.columns), canon(df.columns, [tuple(r) for r in df.collect()])
