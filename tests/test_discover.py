"""What is discovered in a small text, against its lines read one by one."""

from quire.operators import discover as X
from quire.operators import spans as S

HEADER = "كتاب الأربعين"
LINES = [HEADER, "باب الإيمان", "", "عَنْ عُمَرَ قَالَ رَسُولُ اللَّهِ", "(1) رواه مسلم (2)", HEADER, "١٢", "١٢", "١٢", "باب 3", "نص طويل من كلمات كثيرة جدا هنا لا يكون عنوانا", HEADER, "خاتمة"]


def test_discover(spark):
    books = spark.createDataFrame([("b", "\n".join(LINES), [HEADER, "الأرْبعين", "غير موجود"]), ("empty", "", []), ("none", None, ["x"])], "book_id string, text string, headings array<string>")
    lines = S.line_table(books, "book_id", "text").cache()
    assert [(r["line"], r["n"], r["first_at"]) for r in X.common_lines(lines).collect()] == [(HEADER, 3, 0)]
    got = {r["line_no"]: r["strong"] for r in X.heading_candidates(lines).where("book_id = 'b'").collect()}
    assert got == {0: False, 1: True, 5: False, 11: False, 12: False}
    row = X.figures(lines).where("book_id = 'b'").first()
    assert (row["lines"], row["footnote_start_lines"], row["marker_occurrences"], row["quartiles"]) == (13, 1, 2, [])
    assert sorted(map(tuple, X.missing_headings(books).collect())) == [("b", "غير موجود"), ("none", "x")]


def test_lines_of_rows_that_share_a_key(spark):
    rows = spark.createDataFrame([(1, "ab\nc"), (1, "x\nyz\n"), (2, None), (None, "q")], "k int, t string")
    got = sorted(((r["k"], r["line_no"], r["char_start"], r["char_end"], r["line"]) for r in S.line_table(rows, "k", "t").collect()), key=str)
    assert got == sorted([(1, 0, 0, 2, "ab"), (1, 1, 3, 4, "c"), (1, 0, 0, 1, "x"), (1, 1, 2, 4, "yz"), (1, 2, 5, 5, ""), (None, 0, 0, 1, "q")], key=str)
