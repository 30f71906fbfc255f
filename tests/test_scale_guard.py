"""Static checks: library code never pulls data to the driver."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[1] / "capstream"
FORBIDDEN = re.compile(r"(?<!\bF)\.(collect|toPandas|toLocalIterator|toArrow|localCheckpoint|checkpoint|first|take|head)\(|\.rdd\b|\.pivot\([^,()]*\)")
#: One aggregate row, or one line of a small file, read while a frame is built.
BOUNDED = {"ranking.py": ('i % OVERSAMPLE == middle).alias("p")).toArrow()',), "sinks.py": ("$.id",), "textindex.py": ("# one row of settings", "# of the asked words"),
           "jdbc.py": ("F.col(\"hi\")",)}


def test_no_driver_collection_in_library():
    bad = []
    for p in ROOT.rglob("*.py"):
        if p.relative_to(ROOT).parts[0] == "llm":  # has a list of its own in tests/llm
            continue
        for i, line in enumerate(p.read_text().splitlines(), 1):
            if FORBIDDEN.search(line) and not any(mark in line for mark in BOUNDED.get(p.name, ())):
                bad.append(f"{p.relative_to(ROOT)}:{i}: {line.strip()}")
    assert bad == []


def test_every_registered_query_has_an_oracle_or_is_a_stream():
    import __spark_entry__ as e
    q, o = e.queries(), e.oracle_sql()
    missing = [k for k in q if k not in o and k not in e.LLM_QUERIES]
    assert missing == []
