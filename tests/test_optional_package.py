import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_core_doesnt_need_the_optional_package():
    code = "import sys; sys.modules['ledgerloom.llm'] = None; import __spark_entry__ as e; assert len(e.queries()) > 80 and not any(q.startswith('p1_') for q in e.queries())"
    assert subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT).returncode == 0


def test_nothing_else_imports_it():
    for path in (ROOT / "ledgerloom").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "ledgerloom.llm" not in path.read_text()
