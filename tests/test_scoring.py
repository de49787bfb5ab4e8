import numpy as np
from pyspark.sql import functions as F

from parallex.functions.scores import log_softmax, top1
from parallex.operators.scoring import flatten_scores, masked_ce, mean_val_loss


def rows(seed=0, n=40, v=7, pad=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, v)).astype(np.float32)
    y = rng.integers(0, v, size=n)
    return x, y


def frame(spark, x, y, batch=4):
    data = [(i // batch, i, [float(a) for a in x[i]], int(y[i])) for i in range(len(y))]
    return spark.createDataFrame(data, "batch long, pos long, logits array<float>, label int")


def np_ce(x, y, pad, eps):
    x = x.astype(np.float64)
    lp = x - (np.log(np.exp(x - x.max(1, keepdims=True)).sum(1, keepdims=True)) + x.max(1, keepdims=True))
    keep = y != pad
    nll = -lp[np.arange(len(y)), y]
    smooth = -lp.mean(1)
    loss = (1 - eps) * nll + eps * smooth
    return loss[keep].mean(), keep


def test_log_softmax_and_top1(spark):
    x, y = rows()
    df = frame(spark, x, y)
    got = np.array([r["lp"] for r in df.orderBy("pos").select(log_softmax(F.col("logits")).alias("lp")).collect()])
    xd = x.astype(np.float64)
    ref = xd - np.log(np.exp(xd).sum(1, keepdims=True))
    assert np.allclose(got, ref, atol=1e-9)
    t = [r["t"] for r in df.orderBy("pos").select(top1(F.col("logits")).alias("t")).collect()]
    assert t == list(np.argmax(x, axis=1))


def test_masked_ce_plain_and_smoothed(spark):
    x, y = rows(1)
    df = frame(spark, x, y)
    for eps in (0.0, 0.1):
        ref, keep = np_ce(x, y, 0, eps)
        got = masked_ce(df, pad=0, smoothing=eps).first()
        assert abs(got["loss"] - ref) < 1e-9 and got["n_positions"] == keep.sum()


def test_mean_val_loss_is_unweighted(spark):
    x, y = rows(2, n=12)
    df = frame(spark, x, y, batch=4)
    per = masked_ce(df, pad=0, by=["batch"])
    ref = np.mean([np_ce(x[b * 4:(b + 1) * 4], y[b * 4:(b + 1) * 4], 0, 0.0)[0]
                   for b in range(3) if (y[b * 4:(b + 1) * 4] != 0).any()])
    assert abs(mean_val_loss(per).first()["mean_loss"] - ref) < 1e-9
    empty = per.where("false")
    assert mean_val_loss(empty).first()["mean_loss"] == 0.0


def test_flatten(spark):
    df = spark.createDataFrame([(1, [[0.1, 0.9], [0.7, 0.3]], [1, 0])],
                               "k long, logits array<array<float>>, labels array<int>")
    flat = flatten_scores(df, "k").orderBy("pos").collect()
    assert [(r["pos"], r["label"]) for r in flat] == [(0, 1), (1, 0)]
