"""How the tests are laid out."""

from collections import Counter
from pathlib import Path


def test_base_names_are_unique():
    """Folders of tests are no packages, so two files of one name hide each other from collection."""
    names = Counter(p.name for p in Path(__file__).parent.rglob("test_*.py"))
    assert [n for n, times in names.items() if times > 1] == []
