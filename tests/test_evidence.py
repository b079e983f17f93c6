"""Bounded evidence: each reason to refuse a part, by hand."""

import glob
import json

from pyspark.sql import functions as F

from tickloom.plans.q_storage import PART_NAME
from tickloom.sources import parts


def test_each_verdict(spark, tmp_path):
    root = str(tmp_path / "evidence")
    sizes = {"good": 5, "many": 9, "wide": 2, "long": 3, "short": 4, "bytes": 4, "torn": 6, "stray": 1, "null": 2, "boast": 2}
    text = {"wide": "é" * 200, "long": "é" * 40}  # two bytes each
    rows = [(f"{p}-0", i, json.dumps({"i": i, "s": text.get(p, "")}, ensure_ascii=False)) for p, n in sizes.items() for i in range(n)]
    parts.write_parts(spark.createDataFrame(rows, "part string, i int, line string"), "part", "i", "line", root, frame_lines=2)
    (torn,) = glob.glob(f"{root}/**/torn-0-*.jsonl.zst", recursive=True)
    content = open(torn, "rb").read()
    open(torn, "wb").write(content[:-2])
    told = {p: (n, sum(len(x[2].encode()) + 1 for x in rows if x[0] == f"{p}-0")) for p, n in sizes.items() if p != "stray"}
    told |= {"short": (5, told["short"][1]), "bytes": (4, told["bytes"][1] + 1), "null": (None, told["null"][1]), "boast": (8, told["boast"][1]), "gone": (1, 1)}
    declared = spark.createDataFrame([(f"{p}-0", *x) for p, x in told.items()], "part string, rows long, bytes long")
    lines, verdicts = parts.evidence(spark, root, declared, F.regexp_extract("path", PART_NAME, 1), 6, 400, 90, split_bytes=16)
    assert {r.part[:-2]: r.verdict for r in verdicts.collect()} == {
        "good": "accepted", "many": "rows_over", "wide": "bytes_over", "long": "line_over", "short": "rows_differ", "bytes": "bytes_differ",
        "torn": "damaged", "stray": "undeclared", "null": "rows_differ", "boast": "rows_over", "gone": "missing",
    }
    got = sorted(tuple(r) for r in lines.select("part", "record_index", F.get_json_object("line", "$.i").cast("int")).collect())
    assert got == [("good-0", i, i) for i in range(5)]
