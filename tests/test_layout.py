from collections import Counter
from pathlib import Path

import pytest

ROOT = Path(__file__).parent


def test_every_test_file_is_collected():
    names = Counter(p.name for p in ROOT.rglob("test_*.py"))
    assert [n for n, k in names.items() if k > 1] == []


def test_nothing_imports_the_training_subpackage():
    package = ROOT.parent / "rillstone"
    for path in package.rglob("*.py"):
        if "llm" not in path.relative_to(package).parts:
            assert "rillstone.llm" not in path.read_text() and "from .llm" not in path.read_text(), path


def test_a_cluster_needs_a_shared_folder():
    from rillstone.sources import working

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        working.shared_dir(Session())
