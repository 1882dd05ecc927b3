"""Every query of the reference's own operators over the driver's tables, with its SQL.

The tables have no Arabic text, so operators run with parameters that suit them: accented letters as
marks, words for markers, users and orders as books, event ids and dates as places in a text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import text as T
from quire.operators import compare as D
from quire.operators import constraints as C
from quire.operators import discover as X
from quire.operators import headings as E
from quire.operators import knowledge as N
from quire.operators import layout as L
from quire.operators import matching as M
from quire.operators import pages as P
from quire.operators import records as R
from quire.operators import sheets as H
from quire.operators import spans as S
from quire.operators import structure as B
from quire.operators import validate as V
from quire.sources import files, scratch

FLAGSHIP = "repeated_lines"
QUERIES: dict = {}
SQL: dict[str, str] = {}
MARKED = "àâäáãéèêëíìîïñóòôöõúùûüçßÀÂÄÁÉÈÊËÍÌÎÏÑÓÒÔÖÚÙÛÜÇ"
LETTER = r"\p{L}"
VISIBLE = r"\p{P}\p{S}"
#: Tables whose rows are long enough to be dealt out where a file has fewer parts than there are tasks at once.
LONG = ("documents",)


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


def unchecked(f):
    """Register a query that SQL cannot express; tests hold its operator against small books."""
    QUERIES[f.__name__] = f
    return f


def read(spark: SparkSession, sf_dir: str, *names: str):
    found = [files.spread(spark.read.parquet(f"{sf_dir}/{n}.parquet")) if n in LONG else spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]
    return found[0] if len(found) == 1 else found


# --- sources


@query("SELECT doc_id, length(text)::BIGINT AS n_chars, strlen(text)::BIGINT AS n_bytes, sha256(text) AS sha256, contains(text, chr(13) || chr(10)) AS crlf, text LIKE chr(65279) || '%' AS bom FROM documents")
def source_profile(spark, sf_dir) -> DataFrame:
    """Size, digest and line ends of every source."""
    return files.profile(read(spark, sf_dir, "documents"), "doc_id", F.col("text").cast("binary")).drop("text")


@query("SELECT json_extract_string(props, '$.k') IS NULL AS no_key, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL")
def json_fields(spark, sf_dir) -> DataFrame:
    """Fields of JSON text, by type of event."""
    events = read(spark, sf_dir, "events").withColumn("no_key", F.get_json_object("props", "$.k").isNull())
    return events.groupBy("no_key", "event_type").agg(F.count("*").alias("n"))


@query("SELECT page_id, regexp_extract(url, '[0-9]+') AS page_no, row_number() OVER (ORDER BY url NULLS LAST, page_id)::INT AS place FROM pages")
def first_pages_by_name(spark, sf_dir) -> DataFrame:
    """Every name in order, with the first run of digits in each and its place."""
    pages = S.placed(read(spark, sf_dir, "pages").select("page_id", "url"), [F.col("url").asc_nulls_last(), F.col("page_id")], "place")
    return pages.select("page_id", F.regexp_extract("url", "[0-9]+", 0).alias("page_no"), F.col("place").cast("int").alias("place"))


# --- text


@query(r"SELECT doc_id, md5(trim(regexp_replace(text, '[^\p{L}\p{N}]+', ' ', 'g'))) AS quote_form, md5(regexp_replace(text, '\s+', '', 'g')) AS packed_form, length(trim(regexp_replace(text, '\s+', ' ', 'g')))::INT AS spaced_length FROM documents")
def norm_text(spark, sf_dir) -> DataFrame:
    """three normalized views."""
    text = F.col("text")
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(T.QUOTE.apply(text)).alias("quote_form"), F.md5(T.PAGES.apply(text)).alias("packed_form"), F.length(T.ENGINE.apply(text)).alias("spaced_length"))


@query(r"SELECT doc_id, len(list_filter(string_split_regex(text, '\s+'), lambda w: regexp_matches(w, '\p{L}')))::INT AS n_words, len(list_filter(string_split_regex(text, '\s+'), lambda w: regexp_matches(w, '[0-9]')))::INT AS n_with_digits FROM documents")
def word_counts(spark, sf_dir) -> DataFrame:
    """words that have a letter, and words that have a digit."""
    text = F.col("text")
    return read(spark, sf_dir, "documents").select("doc_id", F.size(T.words_with(text, LETTER)).alias("n_words"), F.size(T.words_with(text, "0-9")).alias("n_with_digits"))


@query(rf"SELECT doc_id, coalesce((length(text) - length(regexp_replace(text, '[{MARKED}]', '', 'g')))::DOUBLE / nullif(length(text) - length(regexp_replace(text, '[\p{{L}}]', '', 'g')), 0), 0) AS ratio FROM documents")
def mark_ratio(spark, sf_dir) -> DataFrame:
    """marks per letter."""
    return read(spark, sf_dir, "documents").select("doc_id", T.mark_ratio(F.col("text"), MARKED, LETTER).alias("ratio"))


@query(r"""
WITH runs AS (SELECT unnest(regexp_extract_all(text, '[a-zA-Z]+')) AS r FROM benchmark),
pairs AS (
  SELECT CASE WHEN length(r) = 1 THEN '1' || r ELSE substr(r, i::INT, 2) END AS pair
  FROM runs, LATERAL (SELECT unnest(range(1, greatest(length(r), 2))) AS i))
SELECT pair, count(*)::BIGINT AS n FROM pairs GROUP BY pair
""")
def letter_bigrams(spark, sf_dir) -> DataFrame:
    """the multiset of letter pairs."""
    return read(spark, sf_dir, "benchmark").select(F.explode(T.letter_pairs(F.col("text"), "a-zA-Z")).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


@query(r"""
WITH s AS (SELECT item_id, lower(text) AS t FROM benchmark),
w AS (SELECT item_id, t, i FROM s, LATERAL (SELECT unnest(range(1, length(t) + 1)) AS i))
SELECT item_id, (i - 1)::INT AS char_start, (i + 1)::INT AS char_end FROM w WHERE substr(t, i::INT, 2) = 'th'
""")
def find_all(spark, sf_dir) -> DataFrame:
    """F8: every occurrence of a pattern with its place in the source."""
    items = read(spark, sf_dir, "benchmark")
    return items.select("item_id", F.explode(T.find_all(F.lower("text"), F.lit("th"))).alias("o")).select("item_id", "o.char_start", "o.char_end")


@query(r"""
WITH parts AS (SELECT page_id, regexp_extract_all(url, '[0-9]+') AS m, string_split_regex(url, '[0-9]+') AS b FROM pages),
each AS (SELECT page_id, m, b, unnest(range(1, len(m) + 1)) AS k FROM parts)
SELECT page_id, m[k] AS value,
       (list_sum(list_transform(b[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0))::INT AS char_start
FROM each
""")
def regex_offsets(spark, sf_dir) -> DataFrame:
    """matches of a pattern with code point offsets."""
    pages = read(spark, sf_dir, "pages")
    return pages.select("page_id", F.explode(T.matches_with_offsets(F.col("url"), "[0-9]+")).alias("m")).select("page_id", "m.value", "m.char_start")


# --- lines


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
c AS (SELECT trim(line) AS line, count(*) AS n FROM l WHERE trim(line) <> '' GROUP BY 1 HAVING count(*) >= 3),
s AS (SELECT doc_id, line_no, line, (sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no) - length(line) - 1)::INT AS char_start FROM l)
SELECT s.doc_id, s.line_no::INT AS line_no, s.char_start, (s.char_start + length(s.line))::INT AS char_end, c.n::BIGINT AS n
FROM s JOIN c ON trim(s.line) = c.line
""")
def repeated_lines(spark, sf_dir) -> DataFrame:
    """A1: lines that occur three times or more, with the place of every occurrence; lines meet by digest, so no text moves twice."""
    lines = S.line_table(read(spark, sf_dir, "documents"), "doc_id", "text").where(F.trim("line") != "")
    lines = lines.select("doc_id", "line_no", "char_start", "char_end", F.unhex(F.md5(F.trim("line").cast("binary"))).alias("digest"))
    often = lines.groupBy("digest").agg(F.count("*").alias("n")).where("n >= 3")
    return lines.join(often, "digest").select("doc_id", "line_no", "char_start", "char_end", "n")


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k FROM documents),
c AS (SELECT trim(line) AS line, count(*)::BIGINT AS n, min(doc_id * 1000000 + k)::BIGINT AS first_at FROM l GROUP BY 1)
SELECT line, n, first_at FROM c ORDER BY n DESC, first_at LIMIT 40
""")
def most_common_lines(spark, sf_dir) -> DataFrame:
    """A1: the forty most common lines, ties in first-seen order."""
    lines = S.numbered_lines(read(spark, sf_dir, "documents"), "doc_id", "text")
    counted = lines.groupBy(F.trim("line").alias("line")).agg(F.count("*").alias("n"), F.min(F.col("doc_id") * 1000000 + F.col("line_no")).alias("first_at"))
    return counted.orderBy(F.desc("n"), "first_at").limit(40)


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents)
SELECT doc_id, line_no::INT AS line_no, (sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no) - length(line) - 1)::INT AS char_start,
       (sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no) - 1)::INT AS char_end FROM l
""")
def line_offsets(spark, sf_dir) -> DataFrame:
    """The line table."""
    return S.line_table(read(spark, sf_dir, "documents"), "doc_id", "text").drop("line")


@query(r"""
WITH l AS (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
r AS (SELECT *, count(*) OVER (PARTITION BY line) AS n, lead(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS following FROM l)
SELECT doc_id, line_no::INT AS line_no, line FROM r
WHERE line <> '' AND len(string_split_regex(line, '\s+')) BETWEEN 1 AND 8 AND n < 5
  AND NOT regexp_matches(line, '[0-9:"()\[\]]') AND following IS NOT NULL AND length(following) > 100
""")
def heading_candidates(spark, sf_dir) -> DataFrame:
    """Short rare lines without digits, quotes or brackets, before a long line."""
    lines = S.numbered_lines(read(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "line_no", F.trim("line").alias("line"))
    following = F.lead("line").over(Window.partitionBy("doc_id").orderBy("line_no"))
    short = lines.withColumn("following", following).where((F.col("line") != "") & (F.size(F.split("line", r"\s+")) <= 8) & ~F.col("line").rlike(r'[0-9:"()\[\]]') & (F.length("following") > 100))
    often = lines.groupBy("line").agg(F.count("*").alias("n")).where("n < 5")
    return short.join(often, "line").select("doc_id", "line_no", "line")


@query(r"""
WITH p AS (SELECT doc_id, text, string_split(text, 'license') AS b FROM documents WHERE contains(text, 'license')),
k AS (SELECT *, unnest(range(1, len(b))) AS k FROM p),
o AS (SELECT doc_id, text, (list_sum(list_transform(b[1:k], lambda x: length(x))) + 7 * (k - 1))::BIGINT AS s FROM k),
b AS (SELECT doc_id, s, regexp_extract(substr(text, 1, s), '[^\n]*$') AS before, regexp_extract(substr(text, s + 8), '^[^\n]*') AS after FROM o)
SELECT doc_id, s::INT AS char_start, NOT regexp_matches(before || after, '[^\s\p{P}\p{S}]') AS alone,
       NOT regexp_matches(before, '[^\s\p{P}\p{S}]') OR NOT regexp_matches(after, '[^\s\p{P}\p{S}]') AS at_edge FROM b
""")
def span_on_its_line(spark, sf_dir) -> DataFrame:
    """Whether a term stands alone on its line or at an edge of it, at every place."""
    docs = read(spark, sf_dir, "documents").where(F.contains("text", F.lit("license")))
    found = docs.select("doc_id", "text", F.explode(T.matches_with_offsets(F.col("text"), "license")).alias("m")).select("doc_id", "text", "m.char_start", "m.char_end")
    before = F.regexp_extract(F.substr("text", F.lit(1), F.col("char_start")), r"[^\n]*$", 0)
    after = F.regexp_extract(F.substr("text", F.col("char_end") + 1), r"^[^\n]*", 0)
    return found.select("doc_id", "char_start", T.standalone(before, after, punctuation=VISIBLE).alias("alone"), T.at_line_edge(before, after, punctuation=VISIBLE).alias("at_edge"))


#: Latin texts read by the same rules: accents are marks, a capital article is a marker.
LATIN = X.Script(letters=LETTER, marks=MARKED, marker="The", unlike=r'[0-9:"()\[\]]')
LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents"
RATIO = rf"coalesce((length({{x}}) - length(regexp_replace({{x}}, '[{MARKED}]', '', 'g')))::DOUBLE / nullif(length({{x}}) - length(regexp_replace({{x}}, '[\p{{{{L}}}}]', '', 'g')), 0), 0)"
N_WORDS = r"len(list_filter(string_split_regex({x}, '\s+'), lambda w: regexp_matches(w, '\p{{L}}')))"


@query(rf"""
WITH l AS ({LINES}), v AS (SELECT *, CASE WHEN {N_WORDS.format(x='line')} >= 4 THEN {RATIO.format(x='line')} END AS ratio FROM l),
g AS (SELECT doc_id, count(*)::BIGINT AS lines, count(*) FILTER (WHERE regexp_matches(line, '^\s*The\s*\S'))::BIGINT AS footnote_start_lines, sum(len(regexp_extract_all(line, 'The')))::BIGINT AS marker_occurrences, list_sort(list(ratio) FILTER (WHERE ratio IS NOT NULL)) AS r FROM v GROUP BY doc_id)
SELECT doc_id, lines, footnote_start_lines, marker_occurrences, CASE WHEN len(r) >= 4 THEN r[len(r) // 4 + 1] END AS q1, CASE WHEN len(r) >= 4 THEN r[2 * (len(r) // 4) + 1] END AS q2, CASE WHEN len(r) >= 4 THEN r[3 * (len(r) // 4) + 1] END AS q3 FROM g
""")
def discover_figures(spark, sf_dir) -> DataFrame:
    """Lines, markers, and the quartile steps of marks of every text."""
    found = X.figures(S.numbered_lines(read(spark, sf_dir, "documents"), "doc_id", "text"), LATIN, "doc_id")
    return found.select("doc_id", "lines", "footnote_start_lines", "marker_occurrences", *[F.get("quartiles", F.lit(k)).alias(f"q{k + 1}") for k in range(3)])


@query(rf"""
WITH l AS ({LINES}), v AS (SELECT doc_id, line_no, trim(line) AS line, {N_WORDS.format(x='line')} AS w, {RATIO.format(x='line')} AS ratio FROM l),
a AS (SELECT *, CASE WHEN lead(w, 1) OVER d >= 1 THEN lead(ratio, 1) OVER d END AS r1, CASE WHEN lead(w, 2) OVER d >= 1 THEN lead(ratio, 2) OVER d END AS r2, CASE WHEN lead(w, 3) OVER d >= 1 THEN lead(ratio, 3) OVER d END AS r3, count(*) OVER (PARTITION BY doc_id, line) AS n FROM v WINDOW d AS (PARTITION BY doc_id ORDER BY line_no)),
c AS (SELECT doc_id, line_no, line, round(coalesce(r1, r2, r3, 0), 2) > 0.05 AS marked FROM a WHERE w BETWEEN 1 AND 8 AND ratio < 0.05 AND NOT regexp_matches(line, '[0-9:"()\[\]]') AND n < 5)
SELECT doc_id, line_no::INT AS line_no, line, marked FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY line_no) <= 120
""")
def discover_headings(spark, sf_dir) -> DataFrame:
    """Short bare rare lines of every text, and whether marked text follows; 120 a text, as the report has them."""
    found = X.heading_candidates(S.numbered_lines(read(spark, sf_dir, "documents"), "doc_id", "text"), LATIN, "doc_id")
    return found.select("doc_id", "line_no", "line", (F.col("following") > 0.05).alias("marked"))


# --- spans


@query("""
WITH m AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS run FROM m)
SELECT user_id, run, event_type, count(*)::BIGINT AS n, min(event_id)::BIGINT AS first_id, max(event_id)::BIGINT AS last_id FROM r GROUP BY ALL
""")
def label_runs(spark, sf_dir) -> DataFrame:
    """Runs of equal labels."""
    return S.runs(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_type", [F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")])


@query("""
WITH m AS (SELECT *, CASE WHEN event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) < 40 THEN 0 ELSE 1 END AS c FROM events),
r AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS run FROM m)
SELECT user_id, run, min(event_id)::BIGINT AS a, max(event_id)::BIGINT AS b, count(*)::BIGINT AS n FROM r GROUP BY ALL
""")
def runs_within_gap(spark, sf_dir) -> DataFrame:
    """Places joined to ranges while the gap is small."""
    return S.runs_within(read(spark, sf_dir, "events"), ["user_id"], "event_id", 40, [F.min("event_id").alias("a"), F.max("event_id").alias("b"), F.count("*").alias("n")])


@query("""
SELECT event_id, user_id, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_view FROM events
""")
def asof_last_event(spark, sf_dir) -> DataFrame:
    """As-of lookup."""
    return S.last_before(read(spark, sf_dir, "events"), ["user_id"], "event_id", F.col("event_type") == "view", F.col("event_id"), "last_view").select("event_id", "user_id", "last_view")


@query("""
SELECT event_id, last_value(CASE WHEN value > 50 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS kind_before,
       first_value(CASE WHEN value > 50 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS kind_after FROM events
""")
def neighbour_agreement(spark, sf_dir) -> DataFrame:
    """The nearest strong neighbours on both sides."""
    return S.two_sided(read(spark, sf_dir, "events"), ["user_id"], "event_id", F.when(F.col("value") > 50, F.col("event_type")), "kind").select("event_id", "kind_before", "kind_after")


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
s AS (SELECT doc_id, line_no, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no) - length(line) - 1 AS at FROM l),
p AS (SELECT doc_id, unnest(range(0, n_chars // 1800 + 1)) AS page FROM documents)
SELECT s.doc_id, p.page::INT AS page, count(*)::BIGINT AS n_lines, min(line_no)::INT AS first_line FROM s JOIN p ON s.doc_id = p.doc_id AND s.at >= p.page * 1800 AND s.at < (p.page + 1) * 1800 GROUP BY ALL
""")
def line_in_page(spark, sf_dir) -> DataFrame:
    """Lines in the pages that hold their starts."""
    docs = read(spark, sf_dir, "documents")
    pages = docs.select("doc_id", F.explode(F.sequence(F.lit(0), F.floor(F.col("n_chars") / 1800).cast("int"))).alias("page"))
    pages = pages.select("doc_id", "page", (F.col("page") * 1800).alias("page_start"), (F.col("page") * 1800 + 1800).alias("page_end"))
    found = S.containing(S.line_table(docs, "doc_id", "text").select("doc_id", "line_no", "char_start"), pages, ["doc_id"], "char_start", "page_start", "page_end", 4096)
    return found.groupBy("doc_id", "page").agg(F.count("*").alias("n_lines"), F.min("line_no").alias("first_line"))


SPANS = "SELECT user_id, event_id, event_id AS s, event_id + ceil(value * 3)::BIGINT AS e FROM events"


def spans(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_id").alias("s"), (F.col("event_id") + F.ceil(F.col("value") * 3)).alias("e"))


@query(f"""
WITH p AS ({SPANS}),
d AS (SELECT user_id, x, sum(d) AS d FROM (SELECT user_id, s AS x, 1 AS d FROM p WHERE s < e UNION ALL SELECT user_id, e, -1 FROM p WHERE s < e) GROUP BY ALL),
c AS (SELECT user_id, sum(d) OVER (PARTITION BY user_id ORDER BY x) AS depth, lead(x) OVER (PARTITION BY user_id ORDER BY x) - x AS width FROM d)
SELECT user_id, coalesce(sum(width) FILTER (WHERE depth > 0), 0)::BIGINT AS covered, coalesce(sum(width) FILTER (WHERE depth > 1), 0)::BIGINT AS overlapped, max(depth)::BIGINT AS deepest FROM c GROUP BY user_id
""")
def coverage_check(spark, sf_dir) -> DataFrame:
    """How much is covered, and how much more than once."""
    return S.coverage(spans(spark, sf_dir), ["user_id"], "s", "e")


@query(f"""
WITH p AS ({SPANS}), l AS (SELECT *, lag(e) OVER (PARTITION BY user_id ORDER BY s, event_id) AS previous_end FROM p)
SELECT user_id, event_id, s, e, previous_end FROM l WHERE previous_end > s
""")
def adjacent_overlap(spark, sf_dir) -> DataFrame:
    """Spans that begin before the one ahead has ended."""
    return S.overlapping_neighbours(spans(spark, sf_dir), ["user_id"], "s", "e", "event_id")


@query(f"""
WITH p AS ({SPANS}), c AS (SELECT user_id, event_id AS host, event_id AS hs, event_id + 400 AS he FROM events WHERE event_type = 'purchase')
SELECT p.user_id, p.event_id, c.host, greatest(p.s, c.hs)::BIGINT AS char_start, least(p.e, c.he)::BIGINT AS char_end, (c.hs <= p.s AND p.e <= c.he) AS contained
FROM p JOIN c ON p.user_id = c.user_id AND greatest(p.s, c.hs) < least(p.e, c.he)
""")
def span_overlaps(spark, sf_dir) -> DataFrame:
    """Overlap, containment and the shared part."""
    hosts = read(spark, sf_dir, "events").where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("host"), F.col("event_id").alias("hs"), (F.col("event_id") + 400).alias("he"))
    met = S.intersections(spans(spark, sf_dir), hosts, ["user_id"], ("s", "e"), ("hs", "he"))
    return met.select("user_id", "event_id", "host", "char_start", "char_end", ((F.col("hs") <= F.col("s")) & (F.col("e") <= F.col("he"))).alias("contained"))


@query("""
WITH p AS (SELECT user_id, event_type AS label, event_id AS s, event_id + 150 AS e, value AS layer, event_id AS seq FROM events),
a AS (SELECT DISTINCT user_id, unnest([s, e]) AS a FROM p),
c AS (SELECT user_id, a, lead(a) OVER (PARTITION BY user_id ORDER BY a) AS b FROM a),
t AS (SELECT c.user_id, c.a, c.b, arg_max(p.label, {'l': p.layer, 'q': p.seq}) AS label FROM c JOIN p ON p.user_id = c.user_id AND p.s <= c.a AND c.b <= p.e WHERE c.b IS NOT NULL GROUP BY ALL),
m AS (SELECT *, CASE WHEN lag(b) OVER w = a AND lag(label) OVER w = label THEN 0 ELSE 1 END AS n FROM t WINDOW w AS (PARTITION BY user_id ORDER BY a)),
r AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY a) AS run FROM m)
SELECT user_id, label, min(a)::BIGINT AS char_start, max(b)::BIGINT AS char_end FROM r GROUP BY user_id, run, label
""")
def overlay_labels(spark, sf_dir) -> DataFrame:
    """Labels painted in layers, the top one wins."""
    p = read(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("label"), F.col("event_id").alias("s"), (F.col("event_id") + 150).alias("e"), F.col("value").alias("layer"), F.col("event_id").alias("seq"))
    return S.overlay(p, ["user_id"], "s", "e", ["layer", "seq"], "label")


@query("""
WITH o AS (SELECT o_custkey, o_orderkey, o_orderpriority[1]::INT AS level, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::INT AS place FROM orders)
SELECT a.o_custkey, a.o_orderkey, a.place, a.level,
  (SELECT min(b.place) FROM o b WHERE b.o_custkey = a.o_custkey AND b.place > a.place AND b.level <= a.level) AS section_end,
  (SELECT max(b.place) FROM o b WHERE b.o_custkey = a.o_custkey AND b.place < a.place AND b.level < a.level) AS parent FROM o a
""")
def section_nesting(spark, sf_dir) -> DataFrame:
    """Where a section ends and which one holds it."""
    by = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("level"), F.row_number().over(by).alias("place"))
    return S.nested(o, ["o_custkey"], "place", "level")


TREE = """o AS (SELECT o_custkey, o_orderkey, row_number() OVER w AS k, count(*) OVER (PARTITION BY o_custkey) AS n, lag(o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 2 END) OVER w AS before, last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
t AS (SELECT o_custkey, o_orderkey AS id, CASE WHEN o_custkey % 10 = 0 AND k = 1 THEN last WHEN o_custkey % 10 = 5 AND k = n THEN -1 ELSE before END AS parent FROM o)"""


def order_tree(spark, sf_dir) -> DataFrame:
    """(o_custkey, id, parent): every order below one before it of its customer, in chains or in two; with cycles, and parents that are not there."""
    by = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    whole = Window.partitionBy("o_custkey")
    key = F.col("o_custkey")
    before = F.when(key % 3 == 0, F.lag("o_orderkey", 1).over(by)).otherwise(F.lag("o_orderkey", 2).over(by))
    k, n = F.row_number().over(by), F.count("*").over(whole)
    parent = F.when((key % 10 == 0) & (k == 1), F.max("o_orderkey").over(whole)).when((key % 10 == 5) & (k == n), F.lit(-1)).otherwise(before)
    return read(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("id"), parent.cast("long").alias("parent"))


@query(f"""
WITH RECURSIVE {TREE},
r AS (SELECT o_custkey, id, id AS root, 0 AS depth FROM t WHERE parent IS NULL UNION ALL SELECT t.o_custkey, t.id, r.root, r.depth + 1 FROM t JOIN r ON t.o_custkey = r.o_custkey AND t.parent = r.id)
SELECT t.o_custkey, t.id, r.root, r.depth::INT AS depth FROM t LEFT JOIN r ON r.o_custkey = t.o_custkey AND r.id = t.id
""")
def tree_depths(spark, sf_dir) -> DataFrame:
    """The root above every row and how far it is; none on and below cycles and parents that are not there."""
    return S.trees(order_tree(spark, sf_dir), ["o_custkey"], "id", "parent")


@query(f"""
WITH RECURSIVE {TREE},
r AS (SELECT o_custkey, id FROM t WHERE parent IS NULL AND id % 7 <> 0 UNION ALL SELECT t.o_custkey, t.id FROM t JOIN r ON t.o_custkey = r.o_custkey AND t.parent = r.id)
SELECT o_custkey, id FROM t WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.o_custkey = t.o_custkey AND r.id = t.id)
""")
def unreachable_nodes(spark, sf_dir) -> DataFrame:
    """V6: nodes that do not hang on a given root."""
    nodes = order_tree(spark, sf_dir)
    return C.unreachable(nodes, nodes.where("parent is null and id % 7 <> 0").select("o_custkey", "id"), ["o_custkey"], "id", "parent").select("o_custkey", "id")


@query("SELECT o_custkey, o_orderkey, o_orderdate, coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), TIMESTAMP '2100-01-01') AS until FROM orders")
def unit_extents(spark, sf_dir) -> DataFrame:
    """A unit ends where the next begins, the last at the end of the main part."""
    o = read(spark, sf_dir, "orders").withColumn("_o", F.struct("o_orderdate", "o_orderkey"))
    return S.extents(o, ["o_custkey"], "_o", "o_orderdate", F.lit("2100-01-01").cast("timestamp_ntz").cast(o.schema["o_orderdate"].dataType), "until").select("o_custkey", "o_orderkey", "o_orderdate", "until")


@query("""
WITH s AS (SELECT l_orderkey, l_linenumber, row_number() OVER w AS k, round(l_quantity)::BIGINT AS v FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice))
SELECT l_orderkey, k::INT AS k, v, (max(v - k) OVER (PARTITION BY l_orderkey ORDER BY k) + k)::BIGINT AS clamped FROM s
""")
def monotone_clamp(spark, sf_dir) -> DataFrame:
    """Starts made to rise."""
    by = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    s = read(spark, sf_dir, "lineitem").select("l_orderkey", F.row_number().over(by).alias("k"), F.round("l_quantity").cast("long").alias("v"))
    return S.clamp_rising(s, ["l_orderkey"], "k", "v", "clamped").select("l_orderkey", "k", "v", "clamped")


@query("""
WITH s AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN floor(value * 10)::BIGINT END AS v FROM events),
w AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN event_id END IGNORE NULLS) OVER b AS pa, last_value(v IGNORE NULLS) OVER b AS va,
        first_value(CASE WHEN v IS NOT NULL THEN event_id END IGNORE NULLS) OVER f AS pb, first_value(v IGNORE NULLS) OVER f AS vb FROM s
      WINDOW b AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), f AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT user_id, event_id, coalesce(v, va + ((vb - va) * (event_id - pa)) // (pb - pa)) AS filled FROM w
""")
def interpolate_missing(spark, sf_dir) -> DataFrame:
    """Gaps filled between known neighbours by integer division."""
    s = read(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_id") % 3 == 0, F.floor(F.col("value") * 10)).alias("v"))
    return S.interpolated(s, ["user_id"], "event_id", "v", "filled").select("user_id", "event_id", "filled")


@query("""
WITH h AS (SELECT user_id, event_id, sum(1 + (event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY event_id RANGE BETWEEN CURRENT ROW AND 499 FOLLOWING) AS heft FROM events)
SELECT user_id, arg_max(event_id, {'h': heft, 'e': -event_id}) AS window_start, max(heft)::BIGINT AS heft FROM h GROUP BY user_id
""")
def best_window(spark, sf_dir) -> DataFrame:
    """The heaviest window of a fixed width, the first on ties."""
    hits = read(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") == "purchase", 2).otherwise(1).alias("w"))
    return S.best_window(hits, ["user_id"], "event_id", "w", 500)


@query("""
WITH g AS (SELECT user_id, event_id, event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS gap FROM events),
p AS (SELECT user_id, list_sort(list(gap) FILTER (WHERE gap IS NOT NULL)) AS s FROM g GROUP BY user_id)
SELECT g.user_id, arg_max(g.event_id, {'g': g.gap, 'e': -g.event_id}) AS zone_top, max(g.gap)::BIGINT AS gap, any_value(p.s[len(p.s) // 2 + 1])::BIGINT AS pitch, max(g.gap) >= 1.3 * any_value(p.s[len(p.s) // 2 + 1]) AS accepted
FROM g JOIN p ON g.user_id = p.user_id WHERE g.gap IS NOT NULL GROUP BY g.user_id
""")
def gap_zones(spark, sf_dir) -> DataFrame:
    """The largest gap against the upper median pitch."""
    by = Window.partitionBy("user_id").orderBy("event_id")
    g = read(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_id") - F.lag("event_id").over(by)).alias("gap")).where("gap is not null")
    found = g.groupBy("user_id").agg(F.max_by("event_id", F.struct(F.col("gap"), -F.col("event_id"))).alias("zone_top"), F.max("gap").alias("gap"), S.upper_median(F.col("gap")).alias("pitch"))
    return found.withColumn("accepted", F.col("gap") >= 1.3 * F.col("pitch"))


@query("""
WITH s AS (SELECT l_returnflag, l_linestatus, list_sort(list(l_quantity)) AS v FROM lineitem GROUP BY ALL)
SELECT l_returnflag, l_linestatus, v[len(v) // 4 + 1] AS q1, v[2 * (len(v) // 4) + 1] AS q2, v[3 * (len(v) // 4) + 1] AS q3 FROM s
""")
def quarter_steps(spark, sf_dir) -> DataFrame:
    """Every quarter of the sorted values, by rank and not by collecting a group."""
    ranked = read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus", "l_quantity").agg(F.count("*").alias("n"))
    keys = Window.partitionBy("l_returnflag", "l_linestatus")
    upto = F.sum("n").over(keys.orderBy("l_quantity"))
    placed = ranked.withColumn("upto", upto).withColumn("step", F.floor(F.sum("n").over(keys) / 4))
    at = lambda k: F.min(F.when(F.col("upto") > k * F.col("step"), F.col("l_quantity"))).alias(f"q{k}")
    return placed.groupBy("l_returnflag", "l_linestatus").agg(at(1), at(2), at(3))


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS a, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS b FROM events) SELECT user_id, max(event_id) FILTER (WHERE a = 3) AS third, max(event_id) FILTER (WHERE b = 1) AS latest FROM r WHERE a = 3 OR b = 1 GROUP BY user_id")
def nth_occurrence(spark, sf_dir) -> DataFrame:
    """The third occurrence and the last."""
    events = read(spark, sf_dir, "events").select("user_id", "event_id")
    third = S.nth(events, ["user_id"], ["event_id"], 3).withColumnRenamed("event_id", "third")
    return S.nth(events, ["user_id"], ["event_id"], -1).withColumnRenamed("event_id", "latest").join(third, "user_id", "left").select("user_id", "third", "latest")


@query("SELECT event_id, printf('unit_%03d', row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS unit_id FROM events")
def unit_ids(spark, sf_dir) -> DataFrame:
    """Padded identifiers by order."""
    return S.numbered(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "unit_%03d", "unit_id").select("event_id", "unit_id")


# --- matching


@query("SELECT doc_id, item_id, (strpos(d.text, b.text) - 1)::INT AS char_start, (strpos(d.text, b.text) - 1 + length(b.text))::INT AS char_end FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def quote_locate(spark, sf_dir) -> DataFrame:
    """Verbatim quotes and their first place."""
    docs, items = read(spark, sf_dir, "documents", "benchmark")
    return M.quote_places(docs, items.withColumnRenamed("text", "quote"), "doc_id", "item_id", "text", "quote")


GRAMS = r"""
g AS (SELECT doc_id, list_aggregate([w[i], w[i+1], w[i+2], w[i+3], w[i+4]], 'string_agg', ' ') AS gram, i - 1 AS p FROM (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents), LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i)),
h AS (SELECT item_id, list_aggregate([w[i], w[i+1], w[i+2], w[i+3], w[i+4]], 'string_agg', ' ') AS gram, i - 1 AS q FROM (SELECT item_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM benchmark), LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i))
"""


@query(f"WITH {GRAMS} SELECT doc_id, item_id, count(*)::BIGINT AS hits, min(p)::INT AS first_word, max(p)::INT AS last_word FROM g JOIN h USING (gram) GROUP BY ALL")
def ngram_hits(spark, sf_dir) -> DataFrame:
    """An inverted index of word 5-grams looked up for every text."""
    docs, items = read(spark, sf_dir, "documents", "benchmark")
    hits = M.gram_hits(docs, items, "doc_id", "item_id", F.col("text"), F.col("text"), 5)
    return hits.groupBy("doc_id", "item_id").agg(F.count("*").alias("hits"), F.min("p").alias("first_word"), F.max("p").alias("last_word"))


PAIRS = """
{n} AS (SELECT {k}, pair, count(*) AS n FROM (SELECT {k}, unnest(list_transform(range(1, length(t)), lambda i: substr(t, i::INT, 2))) AS pair FROM (SELECT {k}, lower(text) AS t FROM {t})) WHERE regexp_full_match(pair, '[a-z]+') GROUP BY ALL),
{n}z AS (SELECT {k}, sum(n) AS z FROM {n} GROUP BY ALL)
"""


@query(f"""
WITH turns AS (SELECT row_number() OVER () AS r, conv_id, turn, text FROM conversations),
{PAIRS.format(n='a', k='r', t='turns')}, {PAIRS.format(n='b', k='item_id', t='benchmark')},
c AS (SELECT r, item_id, sum(least(a.n, b.n)) AS common FROM a JOIN b USING (pair) GROUP BY ALL),
s AS (SELECT r, item_id, common::BIGINT AS common, common::DOUBLE / az.z AS score, common::DOUBLE / bz.z AS cover FROM c JOIN az USING (r) JOIN bz USING (item_id)),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, cover DESC, item_id) = 1)
SELECT conv_id, turn, item_id, common, score, cover FROM best JOIN turns USING (r)
""")
def line_similarity_top(spark, sf_dir) -> DataFrame:
    """The most similar line of every turn by common letter pairs of whole texts."""
    turns, items = read(spark, sf_dir, "conversations", "benchmark")
    return M.closest_by_pairs(turns, items, ["conv_id", "turn"], "item_id", "text", "text")


@query("""
WITH f AS (SELECT user_id, event_id AS fn FROM events WHERE event_type = 'purchase'), a AS (SELECT user_id, event_id AS an FROM events WHERE event_type = 'click')
SELECT user_id, fn, an FROM f JOIN a USING (user_id) QUALIFY row_number() OVER (PARTITION BY user_id, fn ORDER BY an > fn, abs(an - fn), an) = 1
""")
def same_key_nearest_before(spark, sf_dir) -> DataFrame:
    """The nearest row of the same key, those before first: two as-of lookups instead of all pairs."""
    e = read(spark, sf_dir, "events")
    click = F.when(F.col("event_type") == "click", F.col("event_id"))
    near = S.two_sided(e, ["user_id"], "event_id", click, "an").where("event_type = 'purchase'")
    return near.select("user_id", F.col("event_id").alias("fn"), F.coalesce("an_before", "an_after").alias("an")).where("an is not null")


@query("""
WITH RECURSIVE e AS (SELECT user_id, event_id // 2000 AS page, event_id, event_type FROM events),
a AS (SELECT user_id, page, list(event_id) AS every FROM e WHERE event_type = 'click' GROUP BY ALL),
f AS (SELECT user_id, page, event_id, row_number() OVER (PARTITION BY user_id, page ORDER BY event_id) AS k FROM e WHERE event_type = 'purchase'),
r AS (SELECT user_id, page, 0::BIGINT AS k, []::BIGINT[] AS used, NULL::BIGINT AS fn, NULL::BIGINT AS an FROM a
  UNION ALL SELECT user_id, page, k, CASE WHEN an IS NULL THEN used ELSE list_append(used, an) END, fn, an
  FROM (SELECT r.user_id, r.page, f.k, used, f.event_id AS fn,
    list_min(list_transform(list_filter(every, lambda x: NOT list_contains(used, x)), lambda x: {'side': x > f.event_id, 'far': abs(x - f.event_id), 'x': x})).x AS an
    FROM r JOIN a USING (user_id, page) JOIN f ON f.user_id = r.user_id AND f.page = r.page AND f.k = r.k + 1) x)
SELECT user_id, fn, an FROM r WHERE an IS NOT NULL
""")
def nearest_unused(spark, sf_dir) -> DataFrame:
    """Every footnote in turn takes the nearest free anchor of its page, those before first; an anchor serves one footnote."""
    e = read(spark, sf_dir, "events").withColumn("page", F.floor(F.col("event_id") / 2000))
    notes = e.where("event_type = 'purchase'").select("user_id", "page", F.col("event_id").alias("fn"))
    anchors = e.where("event_type = 'click'").select("user_id", "page", F.col("event_id").alias("an"))
    order = [F.col("an") > F.col("fn"), F.abs(F.col("an") - F.col("fn"))]
    return M.assigned(notes.join(anchors, ["user_id", "page"]), ["user_id", "page"], "fn", "an", order).select("user_id", "fn", "an")


@query("""
WITH u AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
s AS (SELECT f.user_id, f.event_id, c.event_id AS owner, f.k - c.k AS back, 2 * (c.event_type = f.event_type)::INT + 4 * (c.value / 100) + CASE WHEN f.k = c.k THEN 0.5 ELSE 0 END AS score FROM u f JOIN u c ON f.user_id = c.user_id AND c.k BETWEEN f.k - 2 AND f.k WHERE f.event_type = 'purchase')
SELECT user_id, event_id, owner, back::INT AS back FROM s QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY score DESC, back) = 1
""")
def lookback_owner_score(spark, sf_dir) -> DataFrame:
    """The owner among the last three, by evidence; an equi-join on the three places."""
    u = read(spark, sf_dir, "events").withColumn("k", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")))
    f = u.where("event_type = 'purchase'").select("user_id", "event_id", F.col("event_type").alias("kind"), F.col("k").alias("fk"), F.explode(F.sequence(F.col("k") - 2, F.col("k"))).alias("k"))
    c = u.select("user_id", "k", F.col("event_id").alias("owner"), F.col("event_type").alias("owner_kind"), "value")
    score = 2 * (F.col("owner_kind") == F.col("kind")).cast("int") + 4 * (F.col("value") / 100) + F.when(F.col("fk") == F.col("k"), 0.5).otherwise(0)
    scored = f.join(c, ["user_id", "k"]).withColumn("score", score).withColumn("back", (F.col("fk") - F.col("k")).cast("int"))
    return M.best_of(scored, ["event_id"], [F.desc("score"), F.asc("back")]).select("user_id", "event_id", "owner", "back")


@query(r"""
WITH t AS (SELECT item_id, unnest(string_split_regex(text, '\s+')) AS term FROM benchmark),
h AS (SELECT doc_id, item_id, avg(contains(d.text, t.term)::INT) AS share FROM documents d, t GROUP BY ALL)
SELECT item_id, count(*) FILTER (WHERE share >= 0.5)::BIGINT AS n_docs, max(share) AS best FROM h GROUP BY item_id
""")
def term_share(spark, sf_dir) -> DataFrame:
    """The share of an item's terms that a text contains, over all texts and terms; the items are few, texts stay."""
    docs, items = read(spark, sf_dir, "documents", "benchmark")
    return M.term_shares(docs, items, "item_id", "text", "text")


# --- constraints


@query("SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_ids(spark, sf_dir) -> DataFrame:
    """A3, V5: repeated identifiers."""
    return C.duplicates(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT 'labels' AS child, count(*)::BIGINT AS n, (SELECT count(*) FROM labels)::BIGINT AS total FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) UNION ALL SELECT 'orders', count(*), (SELECT count(*) FROM orders) FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)")
def fk_orphans(spark, sf_dir) -> DataFrame:
    """Keys that nothing refers to, with the size of the referring side."""
    docs, labels, orders, customer = read(spark, sf_dir, "documents", "labels", "orders", "customer")

    def counted(name: str, child: DataFrame, parent: DataFrame, a: str, b: str) -> DataFrame:
        total = parent.agg(F.count("*").alias("total"))
        return C.orphans(child, parent, a, b).agg(F.count("*").alias("n")).select(F.lit(name).alias("child"), "n").join(total)

    return counted("labels", docs, labels, "doc_id", "doc_id").unionByName(counted("orders", customer, orders, "c_custkey", "o_custkey"))


@query("SELECT l_orderkey, count(*)::BIGINT AS n, min(l_linenumber) AS lowest, max(l_linenumber) AS highest, count(DISTINCT l_linenumber)::BIGINT AS n_distinct, (count(*) - count(l_linenumber))::BIGINT AS n_null FROM lineitem GROUP BY l_orderkey HAVING count(*) > count(l_linenumber) OR count(DISTINCT l_linenumber) < count(*) OR max(l_linenumber) - min(l_linenumber) + 1 <> count(DISTINCT l_linenumber)")
def ordinals_consecutive(spark, sf_dir) -> DataFrame:
    """Numbers that repeat or leave gaps."""
    return C.numbering(read(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("SELECT o_custkey, o_orderkey, a::INT AS by_number, b::INT AS by_place FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_orderdate) AS a, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS b FROM orders) WHERE a <> b")
def numbers_out_of_order(spark, sf_dir) -> DataFrame:
    """Rank by number against rank by place."""
    return C.out_of_order(read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", "o_orderdate").select("o_custkey", "o_orderkey", "by_number", "by_place")


@query("SELECT event_id, s, e, 5000::BIGINT AS n FROM (SELECT event_id, (event_id - 100)::BIGINT AS s, (event_id - 100 + floor(value / 10))::BIGINT AS e FROM events) WHERE NOT (s >= 0 AND s < e AND e <= 5000)")
def range_violations(spark, sf_dir) -> DataFrame:
    """V8: spans outside their text."""
    rows = read(spark, sf_dir, "events").select("event_id", (F.col("event_id") - 100).alias("s"), (F.col("event_id") - 100 + F.floor(F.col("value") / 10)).alias("e"), F.lit(5000).cast("long").alias("n"))
    return C.outside(rows, "s", "e", "n")


@query("SELECT doc_id, (doc_id % 500)::INT AS s FROM (SELECT doc_id, substr(text, (doc_id % 500 + 1)::BIGINT, 20) AS a, substr(lower(text), (doc_id % 500 + 1)::BIGINT, 20) AS b FROM documents) WHERE a <> b")
def offset_text(spark, sf_dir) -> DataFrame:
    """Stored text against the source's slice."""
    s = (F.col("doc_id") % 500).cast("int")
    rows = read(spark, sf_dir, "documents").withColumn("s", s).withColumn("e", s + 20).withColumn("stored", F.substr(F.lower("text"), s + 1, F.lit(20)))
    return C.differing_text(rows, "text", "s", "e", "stored").select("doc_id", "s")


@query("SELECT side, doc_id FROM (SELECT 'a' AS side, doc_id FROM (SELECT doc_id FROM labels WHERE quality = 1 EXCEPT SELECT doc_id FROM labels WHERE toxic = 0) UNION ALL SELECT 'b', doc_id FROM (SELECT doc_id FROM labels WHERE toxic = 0 EXCEPT SELECT doc_id FROM labels WHERE quality = 1))")
def unmirrored(spark, sf_dir) -> DataFrame:
    """What one side has and the other lacks."""
    labels = read(spark, sf_dir, "labels")
    return C.unmirrored(labels.where("quality = 1"), labels.where("toxic = 0"), ["doc_id"])


@query("""
WITH v AS (
  SELECT 'ids' AS "check", 'error' AS severity, l_orderkey::VARCHAR AS key, 'line ' || l_linenumber || ' occurs ' || count(*) || ' times' AS message FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
  UNION ALL SELECT 'confidence', 'warn', l_orderkey::VARCHAR, 'discount ' || round(l_discount * 100)::INT FROM lineitem WHERE l_discount > 0.09
  UNION ALL SELECT 'refs', 'error', o_orderkey::VARCHAR, 'order without lines' FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)),
r AS (SELECT *, row_number() OVER (PARTITION BY "check", severity ORDER BY key, message) AS n FROM v)
SELECT "check", severity, count(*)::BIGINT AS n, array_to_string(list(message ORDER BY n) FILTER (WHERE n <= 40), '; ') AS examples FROM r GROUP BY ALL
""")
def validation_report(spark, sf_dir) -> DataFrame:
    """Checks by union, counts and the first examples."""
    lines, orders = read(spark, sf_dir, "lineitem", "orders")
    found = [
        C.violations(C.duplicates(lines, ["l_orderkey", "l_linenumber"]), "ids", "error", F.col("l_orderkey"), F.concat(F.lit("line "), "l_linenumber", F.lit(" occurs "), "n", F.lit(" times"))),
        C.violations(lines.where("l_discount > 0.09"), "confidence", "warn", F.col("l_orderkey"), F.concat(F.lit("discount "), F.round(F.col("l_discount") * 100).cast("int"))),
        C.violations(C.orphans(orders, lines, "o_orderkey", "l_orderkey"), "refs", "error", F.col("o_orderkey"), F.lit("order without lines")),
    ]
    return C.report(found).withColumn("examples", F.array_join("examples", "; "))


# --- records


@query("SELECT event_type, count(*)::BIGINT AS n, count(DISTINCT user_id)::BIGINT AS n_users, (count(*) FILTER (WHERE value > 50))::DOUBLE / count(*) AS share FROM events GROUP BY event_type")
def role_counts(spark, sf_dir) -> DataFrame:
    """Counts, distinct counts and shares by role."""
    return read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("n_users"), (F.count_if(F.col("value") > 50) / F.count("*")).alias("share"))


@query("""
SELECT user_id, event_type, array_to_string(list(event_id ORDER BY event_id), ',') AS places, ((2 * sum(event_id % 100) + count(*)) // (2 * count(*)))::DOUBLE / 100 AS confidence, arg_min(CASE WHEN value > 50 THEN 'high' ELSE 'low' END, event_id) AS severity, bool_or(value > 90) AS needs_visual_check FROM events GROUP BY ALL
""")
def fold_issues(spark, sf_dir) -> DataFrame:
    """A4, A5: issues folded by type."""
    rows = read(spark, sf_dir, "events").select("user_id", "event_type", "event_id", ((F.col("event_id") % 100).cast("decimal(6,4)") / 100).cast("decimal(6,4)").alias("c"), F.when(F.col("value") > 50, "high").otherwise("low").alias("s"), (F.col("value") > 90).alias("f"))
    folded = R.fold(rows, ["user_id", "event_type"], ["event_id"], F.col("event_id"), "c", "s", "f")
    return folded.select("user_id", "event_type", F.array_join(F.transform("occurrences", lambda x: x.cast("string")), ",").alias("places"), F.col("confidence").cast("double").alias("confidence"), "severity", "needs_visual_check")


@query("""
WITH h AS (SELECT user_id, count(*) FILTER (WHERE value > 95) AS hi, count(*) FILTER (WHERE value BETWEEN 90 AND 95) AS md, count(*) FILTER (WHERE value < 1) AS tr, bool_or(value > 99) AS dis, bool_or(value < 0.1) AS man FROM events GROUP BY user_id),
b AS (SELECT *, least(CASE WHEN dis THEN 0.8 ELSE 0.95 END, CASE WHEN man THEN 0.85 ELSE 0.95 END) - 0.05 * md - 0.15 * hi - 0.03 * tr AS c FROM h)
SELECT user_id, greatest(0.3, c)::DOUBLE AS confidence FROM b
""")
def confidence_score(spark, sf_dir) -> DataFrame:
    """Confidence by rule, in decimals."""
    v = F.col("value")
    h = read(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(v > 95).alias("hi"), F.count_if(v.between(90, 95)).alias("md"), F.count_if(v < 1).alias("tr"), F.bool_or(v > 99).alias("dis"), F.bool_or(v < 0.1).alias("man"))
    return h.select("user_id", R.unit_confidence(F.lit("0.95"), F.col("dis"), F.col("md"), F.col("hi"), F.col("tr"), F.col("man")).cast("double").alias("confidence"))


@query(r"""
WITH t AS (SELECT conv_id, role, turn, replace(text, chr(10), ' ') AS t FROM conversations),
p AS (SELECT *, coalesce(sum(length(t) + 1) OVER (PARTITION BY conv_id, role ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM t)
SELECT conv_id, role, md5(string_agg(t, ' ' ORDER BY turn)) AS text_md5, string_agg(s || ':' || turn, ',' ORDER BY turn) AS spans FROM p GROUP BY ALL
""")
def pieces(spark, sf_dir) -> DataFrame:
    """A speaker's texts joined in order, with the place of each part."""
    p = R.pieces(read(spark, sf_dir, "conversations"), ["conv_id", "role"], ["turn"], "text", "turn")
    spans_ = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["piece_start"], x["char_start"])), ",")
    return p.select("conv_id", "role", F.md5("text").alias("text_md5"), spans_.alias("spans"))


CHECKED = """
c AS (SELECT conv_id, turn, concat_ws(',', CASE WHEN length(text) > 300 THEN 'E_STATEMENT' END, CASE WHEN role NOT IN ('user', 'assistant') THEN 'E_SPEAKER_KIND' END, CASE WHEN length(regexp_replace(text, '[^\\p{L}]', '', 'g')) < 8 THEN 'E_QUOTE_SHORT' END, CASE WHEN turn >= 8 THEN 'E_TOO_MANY' END) AS reasons, text FROM conversations)
""".replace("\\\\", "\\")


def checked(spark, sf_dir) -> DataFrame:
    text = F.col("text")
    return read(spark, sf_dir, "conversations").withColumn("reasons", R.reasons([
        ("E_STATEMENT", F.length(text) > 300),
        ("E_SPEAKER_KIND", ~F.col("role").isin("user", "assistant")),
        ("E_QUOTE_SHORT", F.length(F.regexp_replace(text, r"[^\p{L}]", "")) < 8),
        ("E_TOO_MANY", F.col("turn") >= 8),
    ]))


@query(f"WITH {CHECKED} SELECT conv_id, turn, reasons FROM c WHERE reasons <> ''")
def rejection_codes(spark, sf_dir) -> DataFrame:
    """All reasons against a record."""
    return checked(spark, sf_dir).where(F.size("reasons") > 0).select("conv_id", "turn", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {CHECKED} SELECT conv_id, count(*) FILTER (WHERE reasons = '')::BIGINT AS accepted, count(*) FILTER (WHERE reasons <> '')::BIGINT AS rejected FROM c GROUP BY conv_id")
def accept_reject_counts(spark, sf_dir) -> DataFrame:
    """Accepted and rejected per unit."""
    return checked(spark, sf_dir).groupBy("conv_id").agg(F.count_if(F.size("reasons") == 0).alias("accepted"), F.count_if(F.size("reasons") > 0).alias("rejected"))


@query(r"SELECT doc_id, line_no::INT AS line_no FROM (SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id, n ORDER BY line_no) AS k FROM (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no, trim(regexp_replace(unnest(string_split(text, chr(10))), '[^\p{L}\p{N}]+', ' ', 'g')) AS n FROM documents) WHERE n <> '') WHERE k > 1")
def duplicate_statements(spark, sf_dir) -> DataFrame:
    """Statements that a unit has said before, by their normalized words."""
    lines = S.numbered_lines(read(spark, sf_dir, "documents"), "doc_id", "text").withColumn("said", T.QUOTE.apply(F.col("line"))).where("said <> ''")
    return R.repeats(lines, ["doc_id"], ["said"], ["line_no"]).where("repeat").select("doc_id", "line_no")


@query("SELECT vec_id, round(least(0.85, CASE WHEN label = 0 THEN 0.85 ELSE label / 10 END), 2) AS confidence FROM embeddings")
def least_confidence(spark, sf_dir) -> DataFrame:
    """The lesser of two confidences, 0 counting as none."""
    return read(spark, sf_dir, "embeddings").select("vec_id", R.least_confidence(F.lit(0.85), F.col("label") / 10).alias("confidence"))


@query("""
WITH a AS (SELECT doc_id, quality AS v FROM labels WHERE doc_id % 3 <> 0), b AS (SELECT doc_id, toxic AS v FROM labels WHERE doc_id % 3 <> 1)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.v AS old, b.v AS new, CASE WHEN a.doc_id IS NULL THEN 'added' WHEN b.doc_id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM a FULL JOIN b ON a.doc_id = b.doc_id WHERE a.doc_id IS NULL OR b.doc_id IS NULL OR a.v IS DISTINCT FROM b.v
""")
def snapshot_diff(spark, sf_dir) -> DataFrame:
    """What was added, removed and changed between two snapshots."""
    labels = read(spark, sf_dir, "labels")
    old = labels.where("doc_id % 3 <> 0").select("doc_id", F.col("quality").alias("v"))
    return R.snapshot_diff(old, labels.where("doc_id % 3 <> 1").select("doc_id", F.col("toxic").alias("v")), ["doc_id"], "v")


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def upsert_last_wins(spark, sf_dir) -> DataFrame:
    """K6, K7: the last write of a key wins."""
    return R.upsert(read(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("SELECT 'a' AS side, l_returnflag AS flag, l_linenumber AS n FROM (SELECT l_returnflag, l_linenumber FROM lineitem WHERE l_quantity > 25 EXCEPT SELECT l_returnflag, l_linenumber FROM lineitem WHERE l_discount < 0.001 AND l_tax < 0.001 AND l_quantity < 3) UNION ALL SELECT 'b', l_returnflag, l_linenumber FROM (SELECT l_returnflag, l_linenumber FROM lineitem WHERE l_discount < 0.001 AND l_tax < 0.001 AND l_quantity < 3 EXCEPT SELECT l_returnflag, l_linenumber FROM lineitem WHERE l_quantity > 25)")
def set_difference(spark, sf_dir) -> DataFrame:
    """2.8: what either set lacks."""
    lines = read(spark, sf_dir, "lineitem")
    pick = lambda where: lines.where(where).select(F.col("l_returnflag").alias("flag"), F.col("l_linenumber").alias("n"))
    return R.set_difference(pick("l_quantity > 25"), pick("l_discount < 0.001 and l_tax < 0.001 and l_quantity < 3"))


@query("""
WITH p AS (SELECT user_id, event_id AS s, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS page FROM events WHERE event_type = 'purchase'),
m AS (SELECT user_id, event_id AS x, event_type AS kind FROM events WHERE event_type IN ('click', 'view')),
b AS (SELECT user_id, page, x, kind FROM p JOIN m USING (user_id) WHERE abs(x - s) <= 250 QUALIFY row_number() OVER (PARTITION BY user_id, page ORDER BY abs(x - s), x, kind) = 1),
j AS (SELECT p.user_id, p.page, CASE WHEN p.page = 1 THEN 0 ELSE coalesce(b.x, p.s) END AS v, CASE WHEN p.page = 1 THEN 'document_start' ELSE coalesce(b.kind, 'alignment_only') END AS evidence, CASE WHEN p.page = 1 THEN 0.9 WHEN b.x IS NOT NULL THEN 0.85 ELSE 0.5 END::DOUBLE AS confidence FROM p LEFT JOIN b USING (user_id, page))
SELECT user_id AS book_id, page::INT AS page_index, (max(v - page) OVER (PARTITION BY user_id ORDER BY page) + page)::INT AS char_start, evidence, confidence FROM j
""")
def page_snap(spark, sf_dir) -> DataFrame:
    """Starts moved to the nearest mark in reach, then made to rise."""
    e = read(spark, sf_dir, "events").withColumnRenamed("user_id", "book_id")
    number = F.row_number().over(Window.partitionBy("book_id").orderBy("event_id"))
    pages = e.where("event_type = 'purchase'").select("book_id", number.alias("page_index"), F.col("event_id").alias("char_start"), F.lit(0.5).alias("confidence"))
    return P.snap(pages, e.where("event_type in ('click', 'view')").select("book_id", F.col("event_id").alias("at"), F.col("event_type").alias("kind")))


# --- folds over books


def books(spark, sf_dir) -> DataFrame:
    """Documents as books: their second and fifth lines are headings, their first one a running header; short Latin words are no garbled glyphs here."""
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("book_id"), "text", F.split("text", "\n").alias("lines"))
    heads = F.filter(F.array(F.get("lines", F.lit(1)), F.get("lines", F.lit(4))), lambda x: x.isNotNull() & (F.trim(x) != ""))
    latin = F.struct(F.lit(0).alias("latin_max_run_in_arabic"))
    config = F.to_json(F.struct(F.lit("text").alias("body_role"), heads.alias("unit_headings"), F.array(F.get("lines", F.lit(0))).alias("running_headers"), latin.alias("garbled")))
    return docs.select("book_id", "text", config.alias("config"), F.lit(None).cast("string").alias("overrides"))


@unchecked
def structure_units(spark, sf_dir) -> DataFrame:
    """Every document folded into its relations."""
    return B.build_books(books(spark, sf_dir))


@unchecked
def page_alignment(spark, sf_dir) -> DataFrame:
    """G1: where the thirds of every passage begin in it."""
    items = read(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("book_id"), "text")
    third = F.floor(F.length("text") / 3).cast("int")
    pages = items.select("book_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct((i + 1).alias("page_index"), F.substr("text", i * third + 1, third).alias("text")))).alias("p")).select("book_id", "p.page_index", "p.text")
    return P.align(items, pages)


@query(r"""
WITH t AS (SELECT conv_id, turn, role, text, coalesce(lag(turn) OVER (PARTITION BY conv_id ORDER BY turn), turn) AS piece, trim(regexp_replace(text, '[^\p{L}\p{N}]+', ' ', 'g')) AS said,
  length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters, CASE WHEN role = 'user' THEN 'author' ELSE 'editor' END AS by FROM conversations),
w AS (SELECT a.conv_id, a.turn, concat_ws(',', CASE WHEN a.role NOT IN ('user', 'assistant') THEN 'E_TYPE' END, CASE WHEN a.letters = 0 OR length(a.text) > 300 THEN 'E_STATEMENT' END,
  CASE WHEN a.letters < 8 THEN 'E_QUOTE_SHORT' WHEN a.said = '' OR NOT contains(b.said, a.said) THEN 'E_QUOTE_NOT_FOUND' WHEN a.by <> b.by THEN 'E_SPEAKER_ROLE' END) AS reasons
  FROM t a JOIN t b ON a.conv_id = b.conv_id AND a.piece = b.turn)
SELECT conv_id::VARCHAR AS unit_id, turn::INT AS object, reasons FROM w
""")
def knowledge_check(spark, sf_dir) -> DataFrame:
    """Every turn stated with the turn before as evidence, the first with itself, and what speaks against it."""
    turns = read(spark, sf_dir, "conversations").withColumn("unit_id", F.col("conv_id").cast("string"))
    by = F.when(F.col("role") == "user", "author").otherwise("editor")
    pieces = turns.select("unit_id", F.col("turn").cast("string").alias("piece_id"), by.alias("by"), "text")
    before = F.coalesce(F.lag("turn").over(Window.partitionBy("unit_id").orderBy("turn")), F.col("turn")).cast("string")
    objects = turns.select("unit_id", F.col("turn").cast("int").alias("object"), F.col("role").alias("type"), F.col("text").alias("statement"), F.struct(by.alias("kind"), F.lit("").alias("name_in_text")).alias("said_by"), F.lit("explicit").alias("basis"), F.lit("").alias("inference_reason"), F.array(F.struct(before.alias("piece"), F.col("text").alias("quote"))).alias("evidence"))
    types = spark.createDataFrame([("user",), ("assistant",)], "type string")
    checked_ = N.check_objects(objects, pieces, types, letter=r"\p{L}")
    return checked_.select("unit_id", "object", F.array_join("reasons", ",").alias("reasons"))


@unchecked
def structure_report(spark, sf_dir) -> DataFrame:
    """The constraints over every built document, counted, with examples."""
    source = books(spark, sf_dir)
    return C.report([C.gathered(V.violations(scratch.written(B.build_books(source), "built-books"), source))]).withColumn("examples", F.array_join("examples", "; "))


@unchecked
def line_placement(spark, sf_dir) -> DataFrame:
    """The sentences of every passage placed on pages of two sentences."""
    items = read(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("book_id"), F.posexplode(F.split("text", r"(?<=[.]) ")).alias("line_no", "text"))
    page = (F.floor(F.col("line_no") / 2) + 1).cast("int")
    lines = items.select("book_id", "line_no", page.alias("page_index"), "text")
    printed = lines.select("book_id", "page_index", (F.col("line_no") % 2).cast("int").alias("line"), (F.col("line_no") % 2 * 10.0).alias("y0"), F.upper("text").alias("text"))
    return L.match_lines(lines.withColumn("text", F.lower("text")), printed.withColumn("text", F.lower("text")), LETTER)


# --- rules of builds and their comparison, on rows of the driver's tables


TILES = "SELECT user_id, event_id AS s, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS e, event_type AS a, CASE WHEN value > 50 THEN event_type ELSE 'view' END AS b FROM events"


@query(f"""
WITH t AS ({TILES}), d AS (SELECT * FROM t WHERE e IS NOT NULL AND a <> b),
m AS (SELECT *, CASE WHEN lag(a) OVER w = a AND lag(b) OVER w = b AND s - (lag(e) OVER w - 1) < 40 THEN 0 ELSE 1 END AS n FROM d WINDOW w AS (PARTITION BY user_id ORDER BY s)),
r AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY s) AS run FROM m)
SELECT user_id, a AS old, b AS new, min(s)::BIGINT AS s, max(e)::BIGINT AS e FROM r GROUP BY user_id, run, a, b
""")
def label_diff_runs(spark, sf_dir) -> DataFrame:
    """Where two labellings differ, changes of one pair joined while near."""
    by = Window.partitionBy("user_id").orderBy("event_id")
    rows = read(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("s"), F.lead("event_id").over(by).alias("e"), "event_type", "value").where("e is not null")
    old = rows.select("user_id", "s", "e", F.col("event_type").alias("label"))
    new = rows.select("user_id", "s", "e", F.when(F.col("value") > 50, F.col("event_type")).otherwise("view").alias("label"))
    return D.label_runs(D.changed_spans(old, new, ["user_id"], "label", "s", "e"), ["user_id"], "s", "e")


@query("""
WITH l AS (SELECT conv_id, turn, unnest(string_split(text, '')) AS c FROM conversations),
n AS (SELECT conv_id, turn, c, count(*) AS n FROM l WHERE c <> '' GROUP BY ALL)
SELECT a.conv_id, a.turn, sum(greatest(a.n - coalesce(b.n, 0), 0))::BIGINT AS lacking
FROM n a LEFT JOIN n b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1 AND a.c = b.c WHERE a.turn > 0 GROUP BY ALL
""")
def multiset_lack(spark, sf_dir) -> DataFrame:
    """2.8: how many characters of a turn the turn before lacks, repeats counted; 0 tells containment."""
    turns = read(spark, sf_dir, "conversations")
    n = turns.select("conv_id", "turn", F.explode(F.split("text", "")).alias("c")).where("c <> ''").groupBy("conv_id", "turn", "c").agg(F.count("*").alias("n"))
    before = n.select("conv_id", (F.col("turn") + 1).alias("turn"), "c", "n")
    return M.multiset_lack(n.where("turn > 0"), before, ["conv_id", "turn"], "c").select("conv_id", "turn", "lacking")


@query("SELECT l_orderkey, count(*)::BIGINT AS n, min(l_discount) AS value FROM lineitem GROUP BY l_orderkey HAVING count(*) > 3 AND count(DISTINCT l_returnflag) = 1")
def all_alike(spark, sf_dir) -> DataFrame:
    """Groups of more than three whose rows all say the same."""
    return C.all_alike(read(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_returnflag", [F.min("l_discount").alias("value")])


@query(f"""
WITH p AS ({SPANS}), k AS (SELECT p.*, event_type FROM p JOIN events USING (event_id, user_id)),
last AS (SELECT user_id, max(e) AS last_end FROM k WHERE event_type = 'purchase' GROUP BY user_id)
SELECT k.user_id, k.event_id, last_end FROM k JOIN last ON k.user_id = last.user_id WHERE event_type = 'view' AND s >= last_end
""")
def trailing_rows(spark, sf_dir) -> DataFrame:
    """Rows that begin at or behind the last end of another kind in their group."""
    rows = spans(spark, sf_dir).join(read(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id", "event_id"])
    return S.trailing(rows, ["user_id"], F.col("event_type") == "purchase", F.col("event_type") == "view", "s", "e").select("user_id", "event_id", "last_end")


@query("SELECT user_id, event_id // 100 AS visual_row, min(event_id) FILTER (WHERE event_type = 'click') AS marker FROM events GROUP BY ALL")
def least_marker_per_row(spark, sf_dir) -> DataFrame:
    """The lowest marker of every row, null where there is none."""
    return read(spark, sf_dir, "events").groupBy("user_id", F.floor(F.col("event_id") / 100).alias("visual_row")).agg(F.min(F.when(F.col("event_type") == "click", F.col("event_id"))).alias("marker"))


@query(r"""
WITH parts AS (SELECT page_id, strpos(url, '://') + 2 AS a, regexp_extract_all(url, '[0-9]+') AS m, string_split_regex(url, '[0-9]+') AS b FROM pages),
each AS (SELECT page_id, a, m, b, unnest(range(1, len(m) + 1)) AS k FROM parts),
found AS (SELECT page_id, a, m[k] AS digits, (list_sum(list_transform(b[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0))::INT AS char_start FROM each)
SELECT page_id, digits, char_start FROM found WHERE char_start + length(digits) <= a OR char_start >= a + 16
""")
def digits_beside(spark, sf_dir) -> DataFrame:
    """Digit runs of a line outside a span of it."""
    pages = read(spark, sf_dir, "pages").withColumn("a", F.instr("url", "://") + 2)
    found = T.digits_beside(F.col("url"), F.col("a"), F.col("a") + 16)
    return pages.select("page_id", F.explode(found).alias("m")).select("page_id", F.col("m.value").alias("digits"), "m.char_start")


@query("SELECT c_custkey AS id, true AS known FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 7 = 0) UNION ALL SELECT -n.n_nationkey - 1, false FROM nation n")
def some_units(spark, sf_dir) -> DataFrame:
    """The units that are asked for, and what is asked for in vain."""
    customer, orders, nation = read(spark, sf_dir, "customer", "orders", "nation")
    asked = orders.where("o_orderkey % 7 = 0").select(F.col("o_custkey").cast("long").alias("id")).unionByName(nation.select((-F.col("n_nationkey") - 1).cast("long").alias("id")))
    some, unknown = H.chosen(customer.select(F.col("c_custkey").cast("long").alias("id")), asked)
    return some.select("id", F.lit(True).alias("known")).unionByName(unknown.select("id", F.lit(False).alias("known")))


@query(r"SELECT conv_id, turn, regexp_extract(text, '^\s*(\w{1,4})\s', 1) AS marker FROM conversations")
def sheet_markers(spark, sf_dir) -> DataFrame:
    """the marker that opens a text, empty if there is none."""
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", H.marker_of(F.col("text"), r"^\s*(\w{1,4})\s").alias("marker"))


@query("""SELECT event_id, array_to_string(list_sort(list_distinct(regexp_extract_all(props, '"(k|v)"\\s*:', 1))), ',') AS keys FROM events WHERE len(regexp_extract_all(props, '"(k|v)"\\s*:', 1)) > 0""".replace("\\\\", "\\"))
def forbidden_keys(spark, sf_dir) -> DataFrame:
    """Keys of JSON texts, at any depth, that are not allowed."""
    events = read(spark, sf_dir, "events").select("event_id", F.array_sort(V.forbidden_keys(F.col("props"), ("k", "v"))).alias("keys"))
    return events.where(F.size("keys") > 0).select("event_id", F.array_join("keys", ",").alias("keys"))


@query("""
WITH p AS (SELECT user_id, event_id AS char_start, event_id + 30 + (event_id % 3) AS char_end, event_type FROM events),
parts AS (SELECT user_id, char_start, char_end FROM p WHERE event_type <> 'click'),
places AS (SELECT user_id, char_start, CASE WHEN event_type = 'view' THEN char_start + 31 ELSE char_end END AS char_end FROM p)
SELECT a.user_id, a.char_start, a.char_end FROM places a
WHERE EXISTS (SELECT 1 FROM parts b WHERE b.user_id = a.user_id AND b.char_start = a.char_start) AND NOT EXISTS (SELECT 1 FROM parts b WHERE b.user_id = a.user_id AND b.char_start = a.char_start AND b.char_end = a.char_end)
""")
def inexact_places(spark, sf_dir) -> DataFrame:
    """Places that begin with a part but end otherwise."""
    p = read(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("char_start"), (F.col("event_id") + 30 + F.col("event_id") % 3).alias("char_end"), "event_type")
    places = p.select("user_id", "char_start", F.when(F.col("event_type") == "view", F.col("char_start") + 31).otherwise(F.col("char_end")).alias("char_end"))
    return C.inexact(places, p.where("event_type <> 'click'"), ["user_id"], "char_start", "char_end")


@query("""
WITH m AS (SELECT user_id, event_id AS mark FROM events WHERE event_type = 'click'), p AS (SELECT user_id, event_id AS place FROM events WHERE event_type = 'purchase'),
d AS (SELECT p.user_id, place, min(abs(mark - place)) AS far FROM p JOIN m ON p.user_id = m.user_id GROUP BY ALL)
SELECT user_id, place, far::BIGINT AS far FROM d WHERE far > 80
""")
def far_from_marks(spark, sf_dir) -> DataFrame:
    """Places that no mark is near to, by one ordered pass."""
    e = read(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("place"), "event_type")
    return S.far_from(e.where("event_type = 'purchase'"), e.where("event_type = 'click'"), ["user_id"], "place", 80).select("user_id", "place", "far")


@query("""
WITH f AS (SELECT user_id, event_id % 50 AS fn, min(event_id) AS at FROM events WHERE event_type = 'purchase' GROUP BY ALL), a AS (SELECT user_id, event_id % 50 AS fn FROM events WHERE event_type = 'click'),
c AS (SELECT user_id, fn, count(*) AS n FROM a GROUP BY ALL)
SELECT 'shared' AS problem, user_id, fn FROM c WHERE n > 1 UNION ALL SELECT 'bare', user_id, fn FROM f WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.user_id = f.user_id AND c.fn = f.fn)
""")
def note_pairing(spark, sf_dir) -> DataFrame:
    """Notes that several anchors lead to, and notes that none does."""
    e = read(spark, sf_dir, "events").select("user_id", (F.col("event_id") % 50).alias("fn"), "event_type")
    return C.unpaired(e.where("event_type = 'purchase'").select("user_id", "fn"), e.where("event_type = 'click'").select("user_id", "fn"), ["user_id", "fn"])


@query("""
WITH s AS (SELECT user_id, event_id, event_id AS s, event_id + ceil(value * 3)::BIGINT AS e, CASE WHEN event_id % 5 = 0 THEN 'displaced' ELSE 'in_span' END AS placement FROM events), h AS (SELECT user_id, min(event_id) AS us, max(event_id) AS ue FROM events GROUP BY user_id)
SELECT s.user_id, event_id, placement FROM s JOIN h ON s.user_id = h.user_id WHERE (CASE WHEN us <= s AND e <= ue THEN 'in_span' ELSE 'displaced' END) <> placement
""")
def misplaced(spark, sf_dir) -> DataFrame:
    """Parts whose placement is not what their place tells."""
    parts = spans(spark, sf_dir).withColumn("placement", F.when(F.col("event_id") % 5 == 0, "displaced").otherwise("in_span"))
    held = read(spark, sf_dir, "events").groupBy("user_id").agg(F.min("event_id").alias("us"), F.max("event_id").alias("ue"))
    return C.misplaced(parts.join(held, "user_id"), ("s", "e"), ("us", "ue"), "placement").select("user_id", "event_id", "placement")


REST = r"[\s\-–—•·*_|.:،؛,;!?؟«»()\[\]{}\"''/\\]*"


@query(rf"""
WITH p AS (SELECT doc_id, text, string_split(text, 'license') AS b FROM documents WHERE contains(text, 'license')),
k AS (SELECT *, unnest(range(1, len(b))) AS k FROM p),
o AS (SELECT doc_id, text, (list_sum(list_transform(b[1:k], lambda x: length(x))) + 7 * (k - 1))::BIGINT AS s FROM k),
r AS (SELECT doc_id, s, regexp_extract(substr(text, 1, s), '[^\n]*$') AS before, regexp_extract(substr(text, s + 8), '^[^\n]*') AS after FROM o),
g AS (SELECT *, CASE WHEN regexp_full_match(before || after, '{REST}') THEN 3 WHEN regexp_full_match(regexp_replace(before || after, '[0-9]+', '', 'g'), '{REST}') THEN 2 WHEN regexp_full_match(before, '{REST}') OR regexp_full_match(after, '{REST}') THEN 1 ELSE 0 END AS grade FROM r),
c AS (SELECT doc_id, arg_max(s - length(before), {{'g': grade, 's': s}}) AS char_start, max(grade) AS grade FROM g GROUP BY doc_id)
SELECT doc_id::VARCHAR AS book_id, char_start::INT AS char_start, CASE grade WHEN 3 THEN 'standalone' WHEN 2 THEN 'standalone_with_page_number' ELSE 'glued' END AS stands, CASE grade WHEN 3 THEN 0.95 WHEN 2 THEN 0.85 ELSE 0.75 END::DOUBLE AS confidence FROM c
""")
def chosen_headings(spark, sf_dir) -> DataFrame:
    """Of all places of a heading the one that stands best, the last of equals; where its unit begins, and how sure it is."""
    docs = read(spark, sf_dir, "documents").where(F.contains("text", F.lit("license")))
    config = '{"unit_headings": ["license"], "garbled": {"latin_max_run_in_arabic": 0}}'
    built = B.build_books(docs.select(F.col("doc_id").alias("book_id"), "text", F.lit(config).alias("config"), F.lit(None).cast("string").alias("overrides")))
    return V.relation(built, "unit").select("book_id", "char_start", F.col("role").alias("stands"), "confidence")


HEADINGS = ("the", "and", "of", "License", "in")
LINED = "CASE doc_id % 4 WHEN 0 THEN replace(text, ' ', chr(10)) WHEN 1 THEN replace(replace(text, ' ', chr(10)), 'i', '7') WHEN 2 THEN replace(text, '. ', chr(10)) ELSE text END"


@query(rf"""
WITH RECURSIVE d AS (SELECT doc_id, {LINED} AS text FROM documents WHERE text IS NOT NULL),
q AS (SELECT doc_id, text, h.ordinal, h.heading, string_split(text, h.heading) AS b FROM d, (VALUES {", ".join(f"({i}, '{h}')" for i, h in enumerate(HEADINGS, 1))}) h(ordinal, heading)),
k AS (SELECT *, unnest(range(1, len(b))) AS k FROM q),
o AS (SELECT doc_id, ordinal, heading, text, (list_sum(list_transform(b[1:k], lambda x: length(x))) + length(heading) * (k - 1))::BIGINT AS s FROM k),
r AS (SELECT doc_id, ordinal, s, s + length(heading) AS e, regexp_extract(substr(text, greatest(1, s - 999), least(s, 1000)), '[^\n]*$') AS before, regexp_extract(substr(text, s + length(heading) + 1, 1000), '^[^\n]*') AS after FROM o),
g AS (SELECT doc_id, ordinal, s, e, CASE WHEN regexp_full_match(before || after, '{REST}') THEN 3 WHEN regexp_full_match(regexp_replace(before || after, '\p{{N}}+', '', 'g'), '{REST}') THEN 2 WHEN regexp_full_match(before, '{REST}') OR regexp_full_match(after, '{REST}') THEN 1 ELSE 0 END AS grade FROM r),
a AS (SELECT doc_id, ordinal, list({{'g': grade, 's': s, 'e': e}}) AS spots FROM g GROUP BY ALL),
w AS (SELECT doc_id, {len(HEADINGS) + 1}::BIGINT AS ordinal, 2147483647::BIGINT AS lim, NULL::STRUCT(g INT, s BIGINT, e BIGINT) AS best FROM d
  UNION ALL SELECT doc_id, ordinal, coalesce(best.s, lim), best FROM (SELECT w.doc_id, w.ordinal - 1 AS ordinal, w.lim, list_max(list_filter(a.spots, lambda x: x.e <= w.lim)) AS best FROM w LEFT JOIN a ON a.doc_id = w.doc_id AND a.ordinal = w.ordinal - 1 WHERE w.ordinal > 1) x)
SELECT doc_id, ordinal::INT AS ordinal, best.s::INT AS char_start, best.e::INT AS char_end, best.g::INT AS grade, CASE best.g WHEN 3 THEN 0.95 WHEN 2 THEN 0.85 ELSE 0.8 END::DOUBLE AS confidence FROM w WHERE best IS NOT NULL
""")
def heading_chain(spark, sf_dir) -> DataFrame:
    """Several headings a document, each chosen from the last one back among its occurrences ahead of the next, by how they stand."""
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("book_id"), F.expr(LINED.replace("chr(10)", "'\\n'")).alias("text"))
    headings = docs.select("book_id", F.posexplode(F.array(*map(F.lit, HEADINGS))).alias("ordinal", "heading")).withColumn("ordinal", F.col("ordinal") + 1)
    found = E.chosen(E.occurrences(docs, headings))
    return found.select(F.col("book_id").alias("doc_id"), "ordinal", "char_start", "char_end", "grade", "confidence")


@query(r"""
WITH RECURSIVE b AS (SELECT item_id, text, length(text) AS n, list_filter(range(length(text)), lambda x: NOT regexp_matches(substr(text, x::INT + 1, 1), '\s')) AS src FROM benchmark),
k AS (SELECT *, len(src) AS total, array_to_string(list_transform(src, lambda x: substr(text, x::INT + 1, 1)), '') AS pack FROM b),
g AS (SELECT item_id, p, substr(pack, p::INT + 1, 5) AS gram FROM (SELECT item_id, pack, unnest(range(length(pack) - 4)) AS p FROM k) x),
q AS (SELECT item_id, page, regexp_replace(substr(text, (CASE page WHEN 1 THEN 0 WHEN 2 THEN 2 ELSE item_id % 2 END * (n // 3))::INT + 1, (n // 3)::INT), '\s', '', 'g') AS own FROM b, range(1, 4) y(page)),
a AS (SELECT item_id, page, substr(own, p::INT + 1, 5) AS gram FROM (SELECT item_id, page, own, unnest(range(0, length(own) - 4, 3)) AS p FROM q) x),
h AS (SELECT item_id, page, p, count(*) AS m FROM a JOIN g USING (item_id, gram) GROUP BY ALL),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY item_id, page ORDER BY p) AS run FROM (SELECT *, CASE WHEN p - lag(p) OVER (PARTITION BY item_id, page ORDER BY p) <= 5 THEN 0 ELSE 1 END AS fresh FROM h) x),
c AS (SELECT item_id, page, list_sort(list({'w': -m, 'lo': lo, 'hi': hi})) AS found FROM (SELECT item_id, page, sum(m)::BIGINT AS m, min(p) AS lo, max(p) AS hi FROM r GROUP BY item_id, page, run HAVING count(*) >= 3) x GROUP BY ALL),
w AS (SELECT item_id, 0::BIGINT AS page, 0::BIGINT AS lower, NULL::BIGINT AS lo FROM k
  UNION ALL SELECT item_id, page, greatest(lower, coalesce(pick.hi + 1, lower)), pick.lo FROM (SELECT w.item_id, w.page + 1 AS page, w.lower, coalesce(list_filter(found, lambda x: x.lo >= w.lower)[1], found[1]) AS pick FROM w LEFT JOIN c ON c.item_id = w.item_id AND c.page = w.page + 1 WHERE w.page < 3) x),
s AS (SELECT w.item_id, w.page, lo, total, CASE WHEN w.page = 1 THEN coalesce(lo, 0) ELSE lo END AS st FROM w JOIN k USING (item_id) WHERE w.page > 0),
t AS (SELECT *, last_value(CASE WHEN st IS NOT NULL THEN page END IGNORE NULLS) OVER v AS ap, last_value(st IGNORE NULLS) OVER v AS ast, coalesce(first_value(CASE WHEN st IS NOT NULL THEN page END IGNORE NULLS) OVER f, 4) AS bp, coalesce(first_value(st IGNORE NULLS) OVER f, total) AS bst FROM s
  WINDOW v AS (PARTITION BY item_id ORDER BY page), f AS (PARTITION BY item_id ORDER BY page ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
z AS (SELECT item_id, page, lo, total, max(coalesce(st, ast + round_even((bst - ast) * (page - ap) / (bp - ap), 0)::BIGINT)) OVER (PARTITION BY item_id ORDER BY page) AS st FROM t),
y AS (SELECT *, least(total, greatest(st + 1, coalesce(lead(st) OVER (PARTITION BY item_id ORDER BY page), total))) AS un FROM z)
SELECT item_id::VARCHAR AS book_id, page::INT AS page_index, coalesce(src[st + 1], n)::INT AS char_start, coalesce(src[un + 1], n)::INT AS char_end, CASE WHEN lo IS NULL THEN 'interpolated' ELSE 'text_layer_clusters' END AS evidence, CASE WHEN lo IS NULL THEN 0.6 ELSE 0.9 END::DOUBLE AS confidence
FROM y JOIN k USING (item_id)
""")
def cluster_alignment(spark, sf_dir) -> DataFrame:
    """Thirds of every passage out of order, placed by their heaviest clusters of hits."""
    items = read(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("book_id"), "text", (F.col("item_id") % 2).cast("int").alias("odd"))
    third = F.floor(F.length("text") / 3).cast("int")
    part = lambda i, k: F.struct(F.lit(i).alias("page_index"), F.substr("text", k * third + 1, third).alias("text"))
    pages = items.select("book_id", F.explode(F.array(part(1, F.lit(0)), part(2, F.lit(2)), part(3, F.col("odd")))).alias("p")).select("book_id", "p.page_index", "p.text")
    return P.align_clusters(items, pages)


@query("""
WITH old AS (SELECT c_custkey AS id, c_name AS slug, 0::BIGINT AS v FROM customer WHERE c_custkey % 3 <> 0), new AS (SELECT c_name AS slug, c_custkey AS seq, (c_custkey * 10)::BIGINT AS v FROM customer WHERE c_custkey % 2 = 0),
n AS (SELECT slug, v, row_number() OVER (ORDER BY slug) + (SELECT max(id) FROM old) AS fresh FROM new WHERE slug NOT IN (SELECT slug FROM old))
SELECT new.slug, coalesce(old.id, n.fresh)::BIGINT AS id, new.v FROM new LEFT JOIN old ON new.slug = old.slug LEFT JOIN n ON n.slug = new.slug
""")
def upsert_returning(spark, sf_dir) -> DataFrame:
    """K7: the ids of written rows, old ones for keys that were there and new ones behind them for others."""
    customer = read(spark, sf_dir, "customer")
    old = customer.where("c_custkey % 3 <> 0").select(F.col("c_custkey").cast("long").alias("id"), F.col("c_name").alias("slug"), F.lit(0).cast("long").alias("v"))
    new = customer.where("c_custkey % 2 = 0").select(F.col("c_name").alias("slug"), F.col("c_custkey").alias("seq"), (F.col("c_custkey") * 10).cast("long").alias("v"))
    return R.upsert_returning(old, new, ["slug"], ["seq"], "id").select("slug", "id", "v")
