"""Static checks: what the operators bring to the driver is bounded, and they use no local checkpoints or folders."""

import pathlib
import re

import capstream.llm

ROOT = pathlib.Path(capstream.llm.__file__).parent
TO_DRIVER = re.compile(r"(?<!\bF)\.(collect|toPandas|toLocalIterator|first|take|head)\(|\.rdd\b|crossJoin|localCheckpoint|tempfile|mkdtemp|/tmp")
#: One aggregate row; samples and longest vectors of stated size; one row per index part; neighbours of a bounded sample.
BOUNDED = {"token_pack.py": ["percentile_approx", "column(0).take(at)", ".take(pa.array(rows))", "flat.take("], "vectors.py": ["F.max(F.size("],
           "exact_topk.py": [".limit(LONGEST)", "ROTATION_SAMPLE", ".take(pa.array("], "quality_gam.py": ["a bounded number of rows"],
           "ann_tree.py": ["asked.select(\"vec\").collect()", "<= k + 1).collect()", "SAMPLE).select(\"vec\").collect()", ".take(pa.array(", ".take(row)"],
           "warc_index.py": ["a row per index part"], "pii_crf.py": ["# one row of weights"], "align.py": [".take(pa.array(", "self.store = strings.first("]}


def test_only_bounded_rows_reach_the_driver():
    bad = []
    for p in ROOT.glob("*.py"):
        for i, line in enumerate(p.read_text().splitlines(), 1):
            if TO_DRIVER.search(line) and not any(mark in line for mark in BOUNDED.get(p.name, [])):
                bad.append(f"{p.name}:{i}: {line.strip()}")
    assert bad == []


def test_import_errors_are_not_swallowed():
    import corpus_pipeline
    for p in [*ROOT.glob("*.py"), pathlib.Path(corpus_pipeline.__file__)]:
        assert not re.search(r"except (\w*Import\w*|ModuleNotFound\w*|Exception)", p.read_text()), p


def test_native_operator_runs_no_python(spark, sf, capsys):
    from capstream.llm import queries
    queries.op1(spark, sf).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_every_query_is_registered():
    import __spark_entry__ as e
    names = set(e.LLM_QUERIES)
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names - {"pipeline"}} == set(range(1, 14))
    assert set(e.LLM_QUERIES) <= set(e.queries())
    assert {"op1_interleave_shards", "op3_warc_index", "op8_exact_top_k"} <= set(e.oracle_sql())
