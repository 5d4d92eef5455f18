"""Rules the library's own code has to keep."""

import ast
import pathlib

LIBRARY = pathlib.Path(__file__).parent.parent / "overflight"
# Rows brought to the driver, each bounded by design: one row per declared
# check, one per day folder with new files, one per metric and label of a tick,
# one per (region, six hours) that a batch of files touches, one per changed day.
COLLECTS = {
    ("operators/quality.py", "run_gates"), ("streaming/arrivals.py", "_due_days"), ("plans/pipeline.py", "refresh_metrics"),
    ("streaming/arrivals.py", "merge"), ("streaming/arrivals.py", "merge_pieces"), ("plans/pipeline.py", "rebuild_changed"),
}


def calls():
    for path in sorted(p for p in LIBRARY.rglob("*.py") if "llm" not in p.parts):
        for fn in [n for n in ast.walk(ast.parse(path.read_text())) if isinstance(n, ast.FunctionDef)]:
            for call in [n for n in ast.walk(fn) if isinstance(n, ast.Call) and isinstance(n.func, ast.Attribute)]:
                yield str(path.relative_to(LIBRARY)), fn.name, call.func.attr


def test_nothing_unbounded_reaches_the_driver():
    found = {(path, fn) for path, fn, name in calls() if name in ("collect", "toPandas", "toLocalIterator", "take", "head")}
    assert found == COLLECTS


def test_no_python_per_row_and_no_rdd():
    banned = {"udf", "pandas_udf", "applyInPandas", "mapInPandas", "rdd", "localCheckpoint", "crossJoin", "cache"}
    assert not [c for c in calls() if c[2] in banned]
