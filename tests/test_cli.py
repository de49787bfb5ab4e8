import json

from parallex.cli import main
from parallex.session import scale_conf


def test_prepare_and_translate(spark, tmp_dir, capsys):
    path = f"{tmp_dir}/corpus.json"
    rows = [{"pair_id": i, "translation": {"en": f"the cat {i % 3}", "ja": f"ねこ {i % 3} です"}} for i in range(20)]
    with open(path, "w") as fh:
        fh.write("\n".join(json.dumps(r, ensure_ascii=False) for r in rows))
    assert main(["prepare", "--corpus", path, "--format", "json", "--out", f"{tmp_dir}/prep"]) == 0
    out = capsys.readouterr().out
    assert "train: 18 pairs" in out and "val: 2 pairs" in out
    assert main(["translate", "--prepared", f"{tmp_dir}/prep", "5", "the cat 1", "99"]) == 0
    lines = capsys.readouterr().out.splitlines()
    assert "        ID: 5" in lines
    assert "    SOURCE: the cat 1" in lines
    assert any(line.startswith(" PREDICTED: ") and "[SOS]" not in line for line in lines)


def test_scale_conf_bounds():
    c = scale_conf(100 << 40, executors=1000, cores_per_executor=8)
    assert 128 << 20 <= int(c["spark.sql.files.maxPartitionBytes"]) <= 1 << 30
    assert 3 * 8000 <= int(c["spark.sql.shuffle.partitions"]) <= 200_000
    assert int(c["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) <= (16 << 30) // 8 // 4
    small = scale_conf(1 << 30, executors=2, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
