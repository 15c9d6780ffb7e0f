"""Static guards on the library code (not the tests or tools)."""

from __future__ import annotations

import pathlib
import re

LIBRARY = pathlib.Path(__file__).resolve().parents[2] / "playerlake"

FORBIDDEN = {
    r"\.collect\(": "no driver-side collect in the library",
    r"\.toPandas\(": "no driver-side pandas conversion",
    r"\.take\(|\.head\(|\.first\(": "no row pulls to the driver",
    r"\.show\(": "results are written, not printed in part",
    r"\.rdd\b": "no RDDs, not even to look at a plan",
    r"localCheckpoint": "never localCheckpoint",
    r"\bF\.udf\b|@udf|pandas_udf|\.rdd\.map": "no Python UDFs / RDD maps in the hot path",
    r"crossJoin|how=\"cross\"": "no cross joins",
    r"F\.broadcast\(|\.hint\(": "broadcast only by AQE's measured size, no hints",
}


def test_library_follows_the_rules():
    problems = []
    for path in sorted(LIBRARY.rglob("*.py")):
        if "llm" in path.relative_to(LIBRARY).parts:  # its operators choose their style freely
            continue
        text = path.read_text()
        for pattern, why in FORBIDDEN.items():
            for match in re.finditer(pattern, text):
                line = text.count("\n", 0, match.start()) + 1
                problems.append(f"{path.relative_to(LIBRARY.parent)}:{line}: {why}")
    assert problems == []
