"""The README names only queries that exist."""

from __future__ import annotations

import pathlib
import re

import __spark_entry__ as spec


def test_queries_named_in_the_readme_exist():
    readme = pathlib.Path(spec.__file__).with_name("README.md").read_text()
    table = readme.split("## Coverage")[1]
    known = set(spec.queries())
    for cell in re.findall(r"\|([^|]*)\|\n", table):
        for name in re.findall(r"`([a-z_]+\*?)`", cell):
            if name.endswith("*"):
                assert any(k.startswith(name[:-1]) for k in known), name
            else:
                assert name in known, name
