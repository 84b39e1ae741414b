"""The entry module works without the optional subpackage, and without a library that only it uses."""

import os
import shutil
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op1') for n in q), set(e.oracle_sql()) <= set(q))"


def counted(root, *more):
    out = subprocess.run([sys.executable, "-c", "\n".join([*more, COUNT])], cwd=root, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout.split()[-3:]


def without(*names):
    root = tempfile.mkdtemp(prefix="tidemark-entry-")
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), root)
    shutil.copytree(os.path.join(ROOT, "tidemark"), os.path.join(root, "tidemark"), ignore=shutil.ignore_patterns("__pycache__", *names))
    return root


def test_without_the_subpackage():
    n, ops, named = counted(without("llm"))
    assert int(n) >= 50 and (ops, named) == ("False", "True")


def test_without_a_library_of_the_subpackage():
    n, ops, named = counted(ROOT, "import sys; sys.modules['xxhash'] = sys.modules['tokenizers'] = sys.modules['public_tokenizers'] = None")
    assert int(n) >= 50 and (ops, named) == ("False", "True")
