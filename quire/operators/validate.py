"""The constraints of built books, over the relations that build_books yields, as one long table of violations.

Rules of single rows share one pass, all references one anti-join, all neighbours one window, all repeats one
aggregation each; the rest are joins and windows keyed by book, so a corpus of books is checked in one plan. Texts are
read twice in all: for their lengths, and where checks need the text of spans. The spans of all these checks travel to
a book's text as one list, so that a text moves once; what they find is a table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import text as T
from quire.operators import constraints as C
from quire.operators import spans as S
from quire.sources import scratch

#: Longest noise that is not marked by hand, highest confidence of units with displaced text or grave issues, share of one general role, and how far a sure page start may be from a mark: fixed values.
LONGEST_NOISE, DISPLACED, GRAVE, GENERAL_SHARE, SURE_PAGE, MARK_REACH = 60, 0.8, 0.8, 0.5, 0.8, 80
SEVERITIES = ("low", "medium", "high")
NOTE_ROLES = ("footnote", "takhrij", "gharib")
GENERAL_ROLE = "body"
#: Issues that need no place; noise that may look like text, and what looks like it: fixed values.
PLACELESS = ("page_boundary_unknown", "possibly_missing_component")
TEXT_LIKE_KINDS = ("displaced_heading", "running_header")
TEXT_LIKE = "«|»|رواه|رَوَاهُ|ﷺ"
LETTER_RUNS, FEWEST_RUNS = "[ء-ي]{2,}", 4
FORBIDDEN_KEYS = ("cs", "ce", "start", "end")
KEYS = ["book_id"]


def relation(built: DataFrame, name: str) -> DataFrame:
    return built.where(F.col("relation") == name).drop("relation")


def sized(books: DataFrame) -> DataFrame:
    """(book_id, n): the length of every book."""
    return books.select(F.col("book_id").cast("string").alias("book_id"), F.length(F.coalesce("text", F.lit(""))).alias("n"))


def seen(text: Column) -> Column:
    """How many visible characters a text has."""
    return F.length(F.regexp_replace(text, T.ANY_SPACE, ""))


def with_text(rows: DataFrame, books: DataFrame) -> DataFrame:
    """Rows with the text of their span as span_text; rows of other books and spans that leave their text are left out."""
    columns = [c for c in rows.columns if c != "book_id"]
    lists = rows.groupBy("book_id").agg(F.collect_list(F.struct(*columns)).alias("_rows"))
    met = lists.join(books.select(F.col("book_id").cast("string").alias("book_id"), F.coalesce("text", F.lit("")).alias("_text")), "book_id").withColumn("_n", F.length("_text"))
    inside = F.filter("_rows", lambda x: (x["char_start"] >= 0) & (x["char_start"] <= x["char_end"]) & (x["char_end"] <= F.col("_n")))
    cut = F.transform(inside, lambda x: F.struct(*[x[c].alias(c) for c in columns], F.substr("_text", x["char_start"] + 1, x["char_end"] - x["char_start"]).alias("span_text")))
    return met.select("book_id", F.inline(cut))


def claims(built: DataFrame) -> DataFrame:
    """(book_id, claim, char_start, char_end): what segments and noise claim, joined to the longest ranges of one claim."""
    segments, noise = relation(built, "segment"), relation(built, "noise")
    rows = segments.select("book_id", F.concat_ws(":", "kind", "owner", "role").alias("claim"), "char_start", "char_end").unionByName(noise.select("book_id", F.concat_ws(":", "kind", "id").alias("claim"), "char_start", "char_end"))
    by = Window.partitionBy("book_id", "claim").orderBy("char_start", "char_end")
    reach = F.max("char_end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    runs = rows.where("char_start < char_end").withColumn("_new", F.when(F.col("char_start") > F.coalesce(reach, F.lit(-1)), 1).otherwise(0)).withColumn("_run", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("book_id", "claim", "_run").agg(F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end")).drop("_run")


def uneven(built: DataFrame, n: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(holes, overlaps): spans that nothing claims, and spans that two claims share, with both; by one window over the claims and both ends of every book of n."""
    by = Window.partitionBy("book_id").orderBy("char_start", "char_end")
    ahead = F.max(F.struct("char_end", "claim")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    ends = n.select("book_id", F.lit(None).cast("string").alias("claim"), F.explode(F.array(F.struct(F.lit(0).alias("s"), F.lit(0).alias("e")), F.struct(F.col("n").alias("s"), F.col("n").alias("e")))).alias("x")).select("book_id", "claim", F.col("x.s").alias("char_start"), F.col("x.e").alias("char_end"))
    met = scratch.written(claims(built).unionByName(ends).withColumn("_ahead", ahead).where(F.col("_ahead.char_end") != F.col("char_start")), "uneven-claims")
    shared = met.where(F.col("claim").isNotNull() & (F.col("_ahead.char_end") > F.col("char_start")))
    overlaps = shared.select("book_id", "claim", F.col("_ahead.claim").alias("other"), "char_start", F.least("char_end", "_ahead.char_end").alias("char_end"))
    holes = met.where(F.col("_ahead.char_end") < F.col("char_start")).select("book_id", F.col("_ahead.char_end").alias("char_start"), F.col("char_start").alias("char_end"))
    return holes, overlaps


def coverage(built: DataFrame, books: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gaps, overlaps): spans with visible text that nothing claims, with it as span_text; and spans that two claims share, with both."""
    holes, overlaps = uneven(built, sized(books))
    return with_text(holes, books).where(seen(F.col("span_text")) > 0), overlaps


def _texts(parts: dict[str, DataFrame], books: DataFrame) -> dict[str, DataFrame]:
    """Every part's rows (book_id, owner if it has one, char_start, char_end) with the text of their span as span_text: gaps that show, noise and headings, and what is blank between segments."""
    owner = lambda rows: F.col("owner") if "owner" in rows.columns else F.lit(None).cast("string").alias("owner")
    asked = [rows.select("book_id", F.lit(part).alias("part"), owner(rows), "char_start", "char_end") for part, rows in parts.items()]
    visible = F.when(F.col("part").isin("gap", "between"), seen(F.col("span_text")) > 0)
    kept = with_text(reduce(DataFrame.unionByName, asked), books).where(F.when(F.col("part") == "between", ~visible).otherwise(F.coalesce(visible, F.lit(True))))
    met = scratch.written(kept, "span-texts")
    return {part: met.where(F.col("part") == part).drop("part") for part in parts}


def forbidden_keys(json: Column, keys: tuple[str, ...] = FORBIDDEN_KEYS) -> Column:
    """The keys of a JSON text that its schema forbids, at any depth; quotes inside strings are escaped, so they open no key."""
    return F.array_distinct(F.regexp_extract_all(json, F.lit(rf'(?<!\\)"({"|".join(keys)})"\s*:'), F.lit(1)))


def profile_differences(stored: DataFrame, actual: DataFrame) -> DataFrame:
    """(book_id, field) of stored profiles (book_id, sha256, n_chars, crlf) that are not what files.profile tells of the source; missing ones are all fields."""
    fields = ("sha256", "n_chars", "crlf")
    met = actual.select(F.col("book_id").cast("string").alias("book_id"), *[F.col(f).alias(f"_{f}") for f in fields]).join(stored.select(F.col("book_id").cast("string").alias("book_id"), *fields), "book_id", "left")
    wrong = F.array_compact(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"_{f}")), F.lit(f)) for f in fields]))
    return met.select("book_id", F.explode(wrong).alias("field"))


def source_violations(profiles: DataFrame) -> DataFrame:
    """Violations by sources as files.profile describes them: no UTF-8 is an error, a byte order mark (it counts as a character) a warning."""
    what = F.when(F.col("text").isNull(), F.struct(F.lit("error").alias("severity"), F.lit("not UTF-8").alias("message"))).when(F.col("bom"), F.struct(F.lit("warn").alias("severity"), F.lit("byte order mark").alias("message")))
    return profiles.withColumn("_w", what).where("_w is not null").select(F.lit("source").alias("check"), "_w.severity", F.col("book_id").cast("string").alias("key"), "_w.message")


def file_violations(found: DataFrame, required: DataFrame) -> DataFrame:
    """Violations by files: found(book_id, name, content text, problem), as files.read_json tells problems; required(name) must be there for every book.

    CRLF line ends are a warning; a byte order mark, broken UTF-8 or JSON, a missing file and a forbidden key are errors.
    """
    book = F.col("book_id").cast("string")
    read = found.where("problem is not null").select(F.when(F.col("problem").isin("bom", "encoding"), "encoding").when(F.col("problem") == "crlf", "encoding").otherwise("json").alias("check"), F.when(F.col("problem") == "crlf", "warn").otherwise("error").alias("severity"), book.alias("key"), F.concat_ws(" ", "name", "problem").alias("message"))
    every = found.select("book_id").distinct().join(required.select("name").distinct())
    absent = every.join(found.select("book_id", "name"), ["book_id", "name"], "left_anti").select(F.lit("files").alias("check"), F.lit("error").alias("severity"), book.alias("key"), F.concat(F.lit("missing "), "name").alias("message"))
    keys = found.select(book.alias("key"), "name", F.explode(forbidden_keys(F.col("content"))).alias("field")).select(F.lit("field_names").alias("check"), F.lit("error").alias("severity"), "key", F.concat_ws(" ", "name", "field").alias("message"))
    return read.unionByName(absent).unionByName(keys)


#: Relations whose rows are spans, and fields that rows must have.
SPANS = ("node", "unit", "segment", "noise", "page", "foreign", "occurrence")
REQUIRED = {
    "node": ("id", "kind", "char_start", "char_end"),
    "unit": ("id", "kind", "ordinal", "owner", "char_start", "char_end", "confidence"),
    "segment": ("kind", "owner", "role", "char_start", "char_end"),
    "noise": ("id", "owner", "char_start", "char_end"),
    "page": ("char_start", "char_end"),
    "issue": ("id", "kind", "role", "note", "confidence"),
}


def _of_rows(built: DataFrame, n: DataFrame) -> DataFrame:
    """Violations of rules that a row breaks by itself: ranges, required fields, severities, confidence, markers."""
    rel, place = F.col("relation"), F.concat_ws("-", "char_start", "char_end")
    yes = lambda c: F.coalesce(c, F.lit(False))
    bounds = F.col("char_start").isNotNull() & F.col("char_end").isNotNull()
    good = (F.col("char_start") >= 0) & (F.col("char_start") < F.col("char_end")) & (F.col("char_end") <= F.col("n"))
    lacks = F.array_join(F.array_compact(F.array(*[F.when((rel == r) & F.col(c).isNull(), F.lit(c)) for r, fields in REQUIRED.items() for c in fields])), ",")
    unsure = rel.isin("unit", "issue") & ~yes(F.col("confidence").between(0, 1))
    note = (rel == "segment") & (F.col("kind") == "unit") & F.col("role").isin(*NOTE_ROLES) & (F.coalesce("note", F.lit("")) == "")
    rules = [
        (rel.isin(*SPANS) & bounds & ~good & (F.col("n") > 0), "offset_range", "error", place),
        (lacks != "", "schema", "error", lacks),
        ((rel == "issue") & ~yes(F.col("role").isin(*SEVERITIES)), "schema", "error", F.col("role")),
        (unsure, "confidence", "error", F.col("id")),
        (note, "footnote_marker", "warn", place),
    ]
    broken = F.array_compact(F.array(*[F.when(yes(bad), F.struct(F.lit(check).alias("check"), F.lit(severity).alias("severity"), message.cast("string").alias("message"))) for bad, check, severity, message in rules]))
    return built.join(n, "book_id").select(F.col("book_id").alias("key"), F.inline(broken)).select("check", "severity", "key", "message")


def _of_references(built: DataFrame) -> DataFrame:
    """Violations of references: every owner, parent, unit, issue and page that a row names exists."""
    rel = F.col("relation")

    def to(rows: Column, target: str, key: Column, check: str) -> Column:
        return F.when(rows & key.isNotNull(), F.struct(F.lit(target).alias("target"), key.cast("string").alias("wanted"), F.lit(check).alias("check")))

    of_unit = (rel == "segment") & (F.col("kind") == "unit")
    each = [to(rel.isin("node", "unit"), "node", F.col("owner"), "tree"), to(of_unit, "unit", F.col("owner"), "refs"), to(rel.isin("foreign", "occurrence"), "unit", F.col("ref"), "refs"), to(rel == "unit_issue", "issue", F.col("ref"), "refs"), to(rel == "segment", "page", F.col("page"), "pages")]
    asked = built.select("book_id", F.inline(F.array_compact(F.array(*each))))
    known = built.where(rel.isin("node", "unit", "issue", "page")).select("book_id", rel.alias("target"), F.col("id").alias("wanted")).distinct()
    lost = asked.join(known, ["book_id", "target", "wanted"], "left_anti")
    return lost.select("check", F.lit("error").alias("severity"), F.col("book_id").alias("key"), F.concat_ws(" ", "target", "wanted").alias("message"))


def _of_repeats(built: DataFrame) -> DataFrame:
    """Violations of uniqueness: ids, and spans of one role of a unit."""
    by_id = F.col("relation").isin("node", "unit", "issue", "noise")
    by_span = (F.col("relation") == "foreign") | (F.col("relation") == "segment") & (F.col("kind") == "unit")
    same = F.when(by_id, F.struct(F.col("id").alias("a"), F.lit("").alias("b"), F.lit(0).alias("s"), F.lit(0).alias("e"))).otherwise(F.struct(F.col("owner").alias("a"), F.when(F.col("relation") == "segment", F.col("role")).alias("b"), F.col("char_start").alias("s"), F.col("char_end").alias("e")))
    again = C.duplicates(built.where(by_id | by_span).withColumn("same", same), ["book_id", "relation", "same"])
    check = F.when(F.col("relation").isin("foreign", "segment"), "duplicate_segment").otherwise("ids")
    return again.select(check.alias("check"), F.lit("error").alias("severity"), F.col("book_id").alias("key"), F.concat_ws(" ", "relation", "same.a", "same.s", "same.e").alias("message"))


def _of_neighbours(built: DataFrame) -> DataFrame:
    """Violations of order: units, pages, and foreign spans of one unit that begin before the one ahead has ended."""
    rows = built.where(F.col("relation").isin("unit", "page", "foreign")).withColumn("group", F.when(F.col("relation") == "foreign", F.col("owner")).otherwise(""))
    met = S.overlapping_neighbours(rows.withColumn("tie", F.coalesce("id", "ref")), ["book_id", "relation", "group"], "char_start", "char_end", "tie")
    check = F.when(F.col("relation") == "page", "pages").otherwise("overlap")
    return met.select(check.alias("check"), F.lit("error").alias("severity"), F.col("book_id").alias("key"), F.concat_ws(" ", "relation", "tie").alias("message"))


def violations(built: DataFrame, books: DataFrame) -> list[DataFrame]:
    """All checks' violations; a report of them is constraints.report.

    built is what build_books yields and should be a table, as many checks read it. Books without rows, with null texts or
    without pages are checked like others. An id that several books have is an error of its own, and these books are not checked
    further, since no rule could tell their rows apart.
    """
    twice = C.duplicates(books.select(F.col("book_id").cast("string").alias("book_id")), KEYS).select(*KEYS)
    if not twice.isEmpty():
        own = books.withColumn("book_id", F.col("book_id").cast("string")).join(twice, KEYS, "left_anti")
        return [*violations(built.join(twice, KEYS, "left_anti"), own), C.violations(twice, "ids", "error", F.col("book_id"), F.lit("several books have this id"))]
    nodes, units, segments, noise, pages = (relation(built, k) for k in ("node", "unit", "segment", "noise", "page"))
    issues, occurrences, foreign, links = (relation(built, k) for k in ("issue", "occurrence", "foreign", "unit_issue"))
    of_unit, n = segments.where("kind = 'unit'"), scratch.written(sized(books), "book-sizes")
    book, place, owner = F.col("book_id"), F.concat_ws("-", "char_start", "char_end"), F.col("owner")
    unit_spans = units.select("book_id", F.col("id").alias("owner"), F.col("char_start").alias("us"), F.col("char_end").alias("ue"))
    holes, overlaps = uneven(built, n)
    by = Window.partitionBy("book_id", "owner").orderBy("char_start")
    same = [F.lag(c).over(by).eqNullSafe(F.col(c)) for c in ("role", "ref", "placement")]
    split = of_unit.withColumn("_same", same[0] & same[1] & same[2]).withColumn("_end", F.lag("char_end").over(by)).where("_same and _end is not null and _end <= char_start")
    between = split.select("book_id", "owner", F.col("_end").alias("char_start"), F.col("char_start").alias("char_end"))
    texts = _texts({"gap": holes, "noise": noise.where("role <> 'override'"), "heading": of_unit.where("role = 'heading'"), "between": between}, books)

    def found(rows: DataFrame, check: str, severity: str, message=place) -> DataFrame:
        return C.violations(rows, check, severity, book, message)

    has = built.groupBy("book_id").agg(F.count_if((F.col("relation") == "node") & F.col("owner").isNull()).alias("roots"), F.count_if(F.col("relation") == "page").alias("pages"))
    whole = n.join(has, "book_id", "left")
    of_book = [("roots is null", "files", "error", F.lit("no relations")), ("roots <> 1", "tree", "error", F.col("roots").cast("string")), ("pages = 0", "pages", "warn", F.lit("no page model"))]
    broken = F.array(*[F.when(F.expr(bad), F.struct(F.lit(check).alias("check"), F.lit(severity).alias("severity"), message.alias("message"))) for bad, check, severity, message in of_book])
    out = [
        _of_rows(built, n),
        _of_references(built),
        _of_repeats(built),
        _of_neighbours(built),
        whole.select(book.alias("key"), F.inline(F.array_compact(broken))).select(*C.VIOLATION),
        found(occurrences.where("ref is not null").select("book_id", "owner").distinct().join(links.select("book_id", F.col("ref").alias("owner")), KEYS + ["owner"], "left_anti"), "refs", "warn", owner),
        found(texts["gap"], "coverage_gap", "error", T.snippet(F.col("span_text"))),
        found(overlaps, "coverage_overlap", "error", F.concat_ws(" ", "claim", "other")),
    ]
    like_text = ~F.col("owner").isin(*TEXT_LIKE_KINDS) & (F.col("span_text").rlike(TEXT_LIKE) | (F.regexp_count("span_text", F.lit(LETTER_RUNS)) >= FEWEST_RUNS))
    wrong = F.array_compact(F.array(F.when(F.length("span_text") > LONGEST_NOISE, "noise_too_long"), F.when(like_text, "noise_content")))
    out.append(texts["noise"].select(F.explode(wrong).alias("check"), F.lit("warn").alias("severity"), book.alias("key"), T.snippet(F.col("span_text")).alias("message")))
    out += [*_of_units(found, units, of_unit, foreign, unit_spans, nodes, issues, links), *_of_issues(found, issues, occurrences, of_unit, foreign, units), *_of_notes(found, of_unit, occurrences), *_of_pages(found, pages, noise)]
    headings = texts["heading"].groupBy("book_id", "owner").agg(F.min_by("span_text", "char_start").alias("title"))
    titled = headings.join(units.select("book_id", F.col("id").alias("owner"), "note"), KEYS + ["owner"])
    out.append(found(titled.where(~F.startswith(F.col("note"), F.col("title"))), "offset_text", "error", owner))
    out.append(found(texts["between"], "fragmented_segments", "warn"))
    return out


def _of_units(found, units, of_unit, foreign, unit_spans, nodes, issues, links) -> list[DataFrame]:
    """Placement, mirrors, roles, numbering and confidence of units."""
    book_owner = ["book_id", "owner"]
    held = of_unit.join(unit_spans, book_owner)
    inside = (F.col("us") <= F.col("char_start")) & (F.col("char_end") <= F.col("ue"))
    misplaced = C.misplaced(held, ("char_start", "char_end"), ("us", "ue"), "placement")
    away = held.where(~inside).select("book_id", F.col("owner").alias("ref"), "char_start", "char_end")
    hosts = unit_spans.withColumnRenamed("owner", "host")
    hosted = S.containing(away, hosts, ["book_id"], "char_start", "us", "ue", 4096).where(F.col("char_end") <= F.col("ue")).select("book_id", F.col("host").alias("owner"), "ref", "char_start", "char_end")
    mirror = ["book_id", "owner", "ref", "char_start", "char_end"]
    unmirrored = hosted.join(foreign.select(*mirror), mirror, "left_anti")
    baseless = foreign.select(*mirror).join(of_unit.select("book_id", F.col("owner").alias("ref"), "char_start", "char_end"), ["book_id", "ref", "char_start", "char_end"], "left_anti")
    roles = of_unit.groupBy(*book_owner).agg(F.max((F.col("role") == "heading").cast("int")).alias("headed"))
    as_owner = units.withColumnRenamed("owner", "parent").withColumnRenamed("id", "owner")
    unheaded = as_owner.join(roles, book_owner, "left").where("coalesce(headed, 0) = 0 and note <> ''")
    general = of_unit.groupBy("book_id").agg(F.avg((F.col("role") == GENERAL_ROLE).cast("int")).alias("share")).where(F.col("share") > GENERAL_SHARE)
    group = ["book_id", "owner", "kind"]
    above = units.join(nodes.select("book_id", F.col("id").alias("owner"), F.col("confidence").alias("_parent")), book_owner).where("confidence > _parent + 1e-9")
    moved = of_unit.where("placement = 'displaced'").select(*book_owner).unionByName(foreign.select(*book_owner)).distinct()
    grave = links.join(issues.where("role = 'high'").select("book_id", F.col("id").alias("ref")), ["book_id", "ref"]).select(*book_owner).distinct()
    alike = C.all_alike(units, ["book_id"], "confidence")
    owner = F.col("owner")
    return [
        found(misplaced, "placement", "error"),
        found(unmirrored, "foreign_mirror", "error"),
        found(baseless, "foreign_mirror", "error"),
        found(unheaded, "roles", "warn", owner),
        found(general, "roles", "warn", F.col("share")),
        found(C.numbering(units, group, "ordinal"), "numbering", "error", F.col("n")),
        found(C.out_of_order(units.where("ordinal is not null"), group, "ordinal", "char_start"), "numbering", "warn", F.col("id")),
        found(above, "confidence", "error", F.col("id")),
        found(as_owner.where(F.col("confidence") > DISPLACED).join(moved, book_owner, "left_semi"), "confidence", "error", owner),
        found(as_owner.where(F.col("confidence") > GRAVE).join(grave, book_owner, "left_semi"), "confidence", "warn", owner),
        found(alike, "confidence", "warn", F.col("n")),
    ]


def _of_issues(found, issues, occurrences, of_unit, foreign, units) -> list[DataFrame]:
    """Places of issues: there is one, it touches the unit that it names, and it ends with a segment it begins with."""
    placed = occurrences.select("book_id", F.col("owner").alias("id")).distinct()
    placeless = issues.where(~F.col("kind").isin(*PLACELESS)).join(placed, ["book_id", "id"], "left_anti")
    named = occurrences.where("ref is not null")
    parts = of_unit.select("book_id", F.col("owner").alias("ref"), "char_start", "char_end").unionByName(foreign.select("book_id", F.col("owner").alias("ref"), "char_start", "char_end"))
    whole = units.select("book_id", F.col("id").alias("ref"), "char_start", "char_end")
    apart = _untouched(named, parts.unionByName(whole))
    exact = ["book_id", "ref", "char_start", "char_end"]
    inexact = C.inexact(named, parts, ["book_id", "ref"], "char_start", "char_end").join(whole.select(*exact), exact, "left_anti")
    return [found(placeless, "issue_location", "warn", F.col("kind")), found(apart, "issue_location", "error"), found(inexact, "offset_consistency", "error")]


def _untouched(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Rows (book_id, ref, span) that share no character with any of the others of the same book and ref."""
    b = others.select(F.col("book_id").alias("_b"), F.col("ref").alias("_r"), F.col("char_start").alias("_s"), F.col("char_end").alias("_e"))
    return rows.join(b, (F.col("book_id") == F.col("_b")) & (F.col("ref") == F.col("_r")) & (F.col("char_start") < F.col("_e")) & (F.col("_s") < F.col("char_end")), "left_anti")


def _of_notes(found, of_unit, occurrences) -> list[DataFrame]:
    """Footnotes have markers and ids, and an anchor each or an issue that says so; anchors have footnotes or an issue."""
    book_owner = ["book_id", "owner"]
    notes, anchors = of_unit.where(F.col("role").isin(*NOTE_ROLES)), of_unit.where("role = 'anchor'")
    nameless = notes.groupBy(*book_owner).agg(F.count_if(F.col("ref").isNotNull()).alias("named")).where("named = 0")
    shared = C.duplicates(anchors.where("ref is not null"), ["book_id", "owner", "ref"])
    first = notes.where("ref is not null").groupBy("book_id", "owner", "ref").agg(F.min_by(F.struct("char_start", "char_end"), "char_start").alias("x")).select("book_id", "owner", F.col("ref").alias("fn"), "x.char_start", "x.char_end")
    bare = first.join(anchors.where("ref is not null").select("book_id", "owner", F.col("ref").alias("fn")).distinct(), ["book_id", "owner", "fn"], "left_anti")

    def unflagged(rows: DataFrame, kind: str) -> DataFrame:
        return _untouched(rows.withColumn("ref", F.col("owner")), occurrences.where(F.col("kind") == kind).where("ref is not null"))

    return [
        found(nameless, "footnote_ids", "warn", F.col("owner")),
        found(shared, "footnote_pairing", "error", F.col("ref")),
        found(unflagged(bare, "unanchored_footnote"), "footnote_pairing", "error", F.col("fn")),
        found(unflagged(anchors.where("ref is null"), "orphan_anchor"), "footnote_pairing", "warn"),
    ]


def _of_pages(found, pages, noise) -> list[DataFrame]:
    """Sure page starts are near a running header or behind a page number; the nearest mark on either side comes from one ordered pass."""
    marks = noise.where("owner in ('running_header', 'page_number')").select("book_id", F.when(F.col("owner") == "page_number", F.col("char_end")).otherwise(F.col("char_start")).alias("at"))
    first = F.row_number().over(Window.partitionBy("book_id").orderBy("char_start", "id")) == 1
    sure = pages.withColumn("_first", first).where(~F.col("_first") & (F.coalesce("confidence", F.lit(0.0)) >= SURE_PAGE)).select("book_id", "id", F.col("char_start").alias("at"))
    return [found(S.far_from(sure, marks, KEYS, "at", MARK_REACH), "page_confidence", "warn", F.col("id"))]


def summary(built: DataFrame, books: DataFrame) -> DataFrame:
    """Per book: numbers of nodes, units, issues, noise spans, pages and segments by role (as JSON), visible and covered characters, and the share of the general role."""
    names = ("node", "unit", "issue", "noise", "page", "segment")
    counts = built.groupBy("book_id").agg(*[F.count_if(F.col("relation") == k).alias(f"{k}s") for k in names])
    roles = relation(built, "segment").where("kind = 'unit'").groupBy("book_id", "role").agg(F.count("*").alias("m"))
    by_role = roles.groupBy("book_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("role", "m"))))).alias("segment_roles"), F.round(F.sum(F.when(F.col("role") == GENERAL_ROLE, F.col("m")).otherwise(0)) / F.sum("m"), 3).alias("body_role_share"))
    gaps, _ = coverage(built, books)
    missed = gaps.groupBy("book_id").agg(F.sum(seen(F.col("span_text"))).alias("missed"))
    visible = books.select(F.col("book_id").cast("string").alias("book_id"), F.length(F.coalesce("text", F.lit(""))).alias("n_chars"), seen(F.coalesce("text", F.lit(""))).alias("visible"))
    return visible.join(missed, "book_id", "left").join(counts, "book_id", "left").join(by_role, "book_id", "left").withColumn("covered", F.col("visible") - F.coalesce("missed", F.lit(0))).drop("missed")
