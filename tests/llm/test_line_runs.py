import pytest

from topicloom.llm import line_runs as L

A, B, C, X = ("alpha " * 10).strip(), ("beta " * 12).strip(), ("gamma " * 11).strip(), ("other " * 9).strip()


def brute(docs, least=L.MIN_CHARS):
    """All runs that just reach ``least`` characters; later copies go."""
    rows = [(d, t, t.split("\n")) for d, t in sorted(set(docs), key=lambda r: (r[0] is not None, r[0] or 0)) if t is not None]
    seen, gone = set(), {}
    for d, t, lines in rows:
        for i in range(len(lines)):
            size, j = 0, i
            while j < len(lines) and size < least:
                size += len(lines[j]) + 1
                j += 1
            if size >= least:
                run = "\n".join(lines[i:j])
                if run in seen:
                    gone.setdefault((d, t), set()).update(range(i, j))
                seen.add(run)
    return {(d, t): "\n".join(x for i, x in enumerate(lines) if i not in gone.get((d, t), ())) for d, t, lines in rows}


CASES = [
    [(1, f"{A}\n{B}"), (2, f"{X}\n{A}\n{B}\n{C}"), (3, f"{B}")],
    [(1, "s\nt\n" + A), (2, "s\nt\n" + A), (3, "s\nt"), (4, "s\n" + A)],
    [(1, "\n".join("short line %d" % k for k in range(9))), (2, "\n".join("short line %d" % k for k in range(2, 12))), (3, "short line 3")],
    [(1, None), (2, ""), (3, "\n\n"), (4, A), (None, A), (5, A), (5, A)],
    [(1, f"{A}\n{A}\n{A}"), (2, A + "\n")],
    [(k, "\n".join(f"{c}{c} x" for c in "abcdefghijklmnopqrstuvwxyz"[k % 3 :])) for k in range(12)],
    [(1, "\n".join(f"line {k % 7}" for k in range(4000)))],
]


@pytest.mark.parametrize("docs", CASES)
def test_against_brute_force(documents, docs):
    kept = L.dedup_lines(documents(*docs))
    expected = brute(docs)
    rows = kept.collect()
    assert len(rows) == len(docs)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "lines"]
    texts = {}
    for r in rows:
        texts.setdefault(r.doc_id, set()).add(r.text)
    for (d, _), text in expected.items():
        assert text in texts[d]


def test_runs_and_counts(documents):
    found = {r.doc_id: r.lines for r in L.dedup_lines(documents(*CASES[0])).collect()}
    assert (found[2].n_lines, found[2].n_removed) == (4, 2)
    assert [tuple(x) for x in found[2].runs] == [(1, 2)]
    assert found[1].n_removed == 0 and found[3].n_removed == 1


def test_no_rows(documents):
    assert L.dedup_lines(documents()).count() == 0


def test_no_python_in_the_plan(documents):
    plan = L.dedup_lines(documents(*CASES[0]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
