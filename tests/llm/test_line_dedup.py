import random
import re

from tests.llm.conftest import ROWS
from tripmart.llm.line_dedup import dedup_lines


def brute(rows):
    """Later occurrences of three-line windows, by (id, position)."""
    seen, gone = {}, set()
    for i, text in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r[0])):
        lines = text.split("\n")
        for p in range(len(lines) - 2):
            window = tuple(lines[p : p + 3])
            if re.search(r"[^\x20\x09-\x0D]", "".join(window)) and seen.setdefault(window, (i, p)) != (i, p):
                gone |= {(i, p), (i, p + 1), (i, p + 2)}
    return {i: None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone) for i, t in rows}


def check(spark, rows):
    found = dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.text for r in found} == brute(rows)
    for r in found:
        before = dict(rows)[r.doc_id]
        assert r.lines_removed == (0 if before is None else before.count("\n") + 1 - (r.text.count("\n") + 1 if r.text else int(before == r.text)))


def test_passages(spark):
    check(spark, [
        (1, "A\nB\nC\nD"),
        (2, "x\nA\nB\nC\nD\ny"),       # a passage of four lines goes as a whole
        (3, "A\nB"),                    # too short for a window
        (4, "A\nB\nC"),                 # nothing else: an empty text stays
        (5, "z\nz\nz\nz\nz"),           # repeats within a document
        (6, "\n\n\n\n"),                # blank windows do not count
        (7, None),
        (8, "B\nC\nE\nB\nC\nF"),        # shares lines, but no window
    ])


def test_random_lines(spark):
    draw = random.Random(5)
    check(spark, [(i, "\n".join(draw.choice("abcd ") for _ in range(draw.randrange(1, 15)))) for i in range(60)])


def test_tricky(tricky, nothing):
    rows = dedup_lines(tricky).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[7].text == "wort und noch ein wort\nwort und noch ein wort\nwort und noch ein wort\n".rsplit("\n", 3)[0] or by_id[7].lines_removed > 29_000
    assert by_id[2].text is None and by_id[3].text == ""
    assert dedup_lines(tricky).columns == [c for c in tricky.columns if c != "lines_removed"] + ["lines_removed"]
    assert dedup_lines(nothing).count() == 0


def test_copies_of_a_row_stay_alike(spark):
    rows = dedup_lines(spark.createDataFrame([(1, "a\nb\nc")] * 2 + [(1, "a\nb\nc\nd")], "doc_id int, text string")).collect()
    assert sorted(r.lines_removed for r in rows) in ([0, 0, 3], [0, 3, 3])
