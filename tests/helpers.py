import glob
import math
import os
import tempfile


def norm(v):
    if v is None:
        return ("N",)
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else ("f", repr(v))
    if isinstance(v, bool):
        return ("i", int(v))
    if isinstance(v, int):
        return ("i", v)
    if hasattr(v, "isoformat"):
        return ("t", v.isoformat())
    return ("s", str(v))


def rows_of(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted(tuple(norm(r[c]) for c in cols) for r in df.select(*cols).collect())


def same_rows(a, b, cols=None):
    cols = cols or sorted(a.columns)
    return rows_of(a, cols) == rows_of(b, cols)


def scratch_of_its_own(spark, monkeypatch):
    """From now on scratch goes to a new folder; a function that gives the names of the scratch folders in it, those within others included."""
    from cardrisk import session

    session.checkpoint_base(spark)
    base = tempfile.mkdtemp(prefix="cardrisk-test-scratch-")
    monkeypatch.setattr(session, "checkpoint_base", lambda spark: base)

    def left():
        found = glob.glob(f"{base}/cardrisk/**/*-" + "[0-9a-f]" * 32, recursive=True)
        return sorted(os.path.basename(p).rsplit("-", 1)[0] for p in found if os.path.isdir(p))

    return left
