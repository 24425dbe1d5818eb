import time
from collections import defaultdict

import pytest

from feedloom.llm import lines

BARE = " \t\n\x0b\f\r"


def brute(rows, least):
    sites = defaultdict(set)
    for _, t, s in rows:
        for line in (t or "").split("\n"):
            sites[line.strip(BARE)].add(s)
    bad = {line for line, s in sites.items() if line and len(s) >= least}
    out = []
    for i, t, _ in rows:
        old = [] if t is None else t.split("\n")
        new = [line for line in old if line.strip(BARE) not in bad]
        out.append((str(i), None if t is None else "\n".join(new), len(old), len(old) - len(new)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows(odd_rows, prose):
    out = list(odd_rows)
    for i in range(240):
        # Line k is on k sites; all of them many times on the hot site.
        text = [prose(i, 9)] + [f" spread {k}\t" for k in range(1, 60) if i % 60 < k] + ["", f"own {i}"]
        out.append((1000 + i, "\n".join(text), f"site{i % 60}"))
    return out + [(5000 + i, "only here\nspread 3\n\nonly here", "hot") for i in range(200)]


@pytest.mark.parametrize("least, limit", [(5, 200_000), (30, 200_000), (12, 0)])
def test_lines_equal_brute_force(docs, rows, monkeypatch, least, limit):
    monkeypatch.setattr(lines, "BROADCAST_ROWS", limit)
    df = docs(rows)
    out = lines.remove_boilerplate(df, least_sites=least)
    assert out.columns == [c for c in df.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    got = sorted(((str(r.doc_id), r.text, r.n_lines, r.n_removed) for r in out.collect()), key=str)
    assert got == brute(rows, least)


def test_empty_table(docs):
    assert lines.remove_boilerplate(docs([])).count() == 0


def test_a_document_of_many_removed_lines(docs):
    """100,000 lines that all go and as many that stay, in one text: linear, so a matter of seconds."""
    shared = [f"line {i}" for i in range(100_000)]
    mixed = "\n".join(line for i, s in enumerate(shared) for line in (s, f"own {i}"))
    rows = [(i, "\n".join(shared), f"site{i}") for i in range(3)] + [(9, mixed, "site0")]
    began = time.monotonic()
    got = {r.doc_id: r for r in lines.remove_boilerplate(docs(rows), least_sites=3).collect()}
    assert time.monotonic() - began < 60
    assert [(got[i].text, got[i].n_removed) for i in range(3)] == [("", 100_000)] * 3
    assert got[9].n_lines == 200_000 and got[9].text == "\n".join(f"own {i}" for i in range(100_000))
