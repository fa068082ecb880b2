"""Paths and parsers shared by the mining tests."""

import glob
import os
import re

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DATA = os.path.join(ROOT, "tests", "data")
SF0001 = "/root/testdata/sf0.001"


def data(name: str) -> str:
    return os.path.join(DATA, name)


def parse_sets(line: str) -> list[tuple[str, ...]]:
    """Itemset literals of one report line -> tuples of item text."""
    return [tuple(x.strip().strip("'") for x in m.split(",")) for m in re.findall(r"\(([^)]*)\)", line)]


def golden_sections(path: str) -> tuple[list[set], list[set]]:
    """(candidates by k, frequent by k) of a report file."""
    text = open(path).read()
    cand_part, freq_part = text.split("Frequent Itemsets:")
    cand_lines = [ln for ln in cand_part.replace("Candidates:", "").split("\n") if ln.strip()]
    freq_lines = [ln for ln in freq_part.split("\n") if ln.strip()]
    return [set(parse_sets(ln)) for ln in cand_lines], [set(parse_sets(ln)) for ln in freq_lines]


def by_k(rows, col="itemset") -> list[set]:
    out: dict[int, set] = {}
    for r in rows:
        out.setdefault(r["k"], set()).add(tuple(r[col]))
    return [out[k] for k in sorted(out)]


def write_text(tmp_path, name: str, text: str) -> str:
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def written(folder: str) -> str:
    """The part files of a report in name order."""
    return "".join(open(f).read() for f in sorted(glob.glob(f"{folder}/part-*")))
