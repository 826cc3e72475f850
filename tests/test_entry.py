"""The entry module loads by file path from any working folder."""

import os
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_loads_by_path_from_elsewhere(tmp_dir):
    code = (
        "import importlib.util\n"
        f"spec = importlib.util.spec_from_file_location('e', {os.path.join(HERE, '__spark_entry__.py')!r})\n"
        "m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)\n"
        "q, s = m.queries(), m.oracle_sql()\n"
        "assert set(s) <= set(q) and len(q) >= 80\n"
        "print('ok', len(q))\n"
    )
    r = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    assert r.stdout.startswith("ok")
