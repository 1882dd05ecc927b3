"""Checking drafted statements against the pieces of their unit: every reason, quotes placed in the source, confidence, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import text as T
from quire.operators import records as R
from quire.operators.sheets import source_parts

#: Limits and vocabularies: fixed values.
MIN_QUOTE_LETTERS, MAX_STATEMENT, MAX_OBJECTS = 8, 300, 8
SPEAKERS = ("author", "prophet", "quran", "quoted", "editor")
EDITOR_VOICE, NAME_REQUIRED = ("editor",), ("prophet", "quoted")
AUTHOR_VOICE = ("author", "prophet", "quran", "quoted")
CONFIDENCE = {"explicit": 0.85, "inferred": 0.6}
PROMPT_VERSION = "ke-v1"
DRAFT = "unit_id STRING, model_used STRING, prompt_version STRING, no_knowledge_reason STRING, objects ARRAY<STRUCT<type: STRING, statement: STRING, said_by: STRUCT<kind: STRING, name_in_text: STRING, reported_by: STRING>, basis: STRING, inference_reason: STRING, evidence: ARRAY<STRUCT<piece: STRING, quote: STRING>>>>"


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def letters(c: Column, letter: str = T.ARABIC) -> Column:
    return F.length(c) - F.length(F.regexp_replace(c, f"[{letter}]", ""))


def draft_reasons(drafts: DataFrame, units: DataFrame, sheets: DataFrame | None = None) -> DataFrame:
    """Drafts by unit, a JSON text each, parsed; with the reasons against a draft as a whole.

    units(unit_id) that are asked for; drafts(unit_id, raw); sheets(unit_id), those that were prepared. A unit without a
    sheet or a draft and a draft that is no JSON are reasons too.
    """
    known = units.select("unit_id") if sheets is None else units.select("unit_id").join(sheets.select("unit_id", F.lit(True).alias("_sheet")).distinct(), "unit_id", "left")
    if sheets is None:
        known = known.withColumn("_sheet", F.lit(True))
    parsed = known.join(drafts, "unit_id", "left").withColumn("draft", F.from_json("raw", DRAFT)).withColumn("_ok", F.try_parse_json("raw").isNotNull())
    n = F.coalesce(F.size("draft.objects"), F.lit(0))
    n = F.greatest(n, F.lit(0))
    whole = F.when(F.col("_sheet").isNull(), F.array(F.lit("E_NO_SHEET"))).when(F.col("raw").isNull(), F.array(F.lit("E_MISSING_DRAFT"))).when(~F.col("_ok"), F.array(F.lit("E_JSON")))
    checks = R.reasons([
        ("E_UNIT", ~F.col("draft.unit_id").eqNullSafe(F.col("unit_id"))),
        ("E_PROMPT_VERSION", ~F.col("draft.prompt_version").eqNullSafe(F.lit(PROMPT_VERSION))),
        ("E_MODEL", blank(F.col("draft.model_used"))),
        ("E_EMPTY", (n == 0) & blank(F.col("draft.no_knowledge_reason"))),
        ("E_TOO_MANY", n > MAX_OBJECTS),
    ])
    return parsed.select("unit_id", "draft", n.alias("n_objects"), F.coalesce(whole, checks).alias("reasons"))


def place_quotes(evidence: DataFrame, pieces: DataFrame) -> DataFrame:
    """evidence(unit_id, object, k, piece, quote) with its piece's by, text and the quote's normalized place (from 0; null: not there)."""
    known = pieces.select("unit_id", F.col("piece_id").alias("piece"), "by", "text", F.lit(True).alias("known"))
    met = evidence.join(known, ["unit_id", "piece"], "left")
    at = F.instr(T.QUOTE.apply(F.col("text")), T.QUOTE.apply(F.col("quote")))
    return met.withColumn("place", F.when((at > 0) & (T.QUOTE.apply(F.col("quote")) != ""), at - 1))


def quoted_parts(evidence: DataFrame, pieces: DataFrame) -> DataFrame:
    """evidence(unit_id, object, k, piece, quote) found in its piece, as (unit_id, object, k, char_start, char_end, role, page): the parts of the source that each quote covers.

    pieces as sheets.pieces has them. Quotes that are not found have no rows; of several places the first counts.
    """
    met = evidence.join(pieces.select("unit_id", F.col("piece_id").alias("piece"), "text"), ["unit_id", "piece"])
    first = F.get(T.find_all(F.col("text"), T.QUOTE.apply(F.col("quote")), T.QUOTE), F.lit(0))
    placed = met.withColumn("_at", first).where("_at is not null").select("unit_id", "object", "k", "piece", F.col("_at.char_start").alias("from"), F.col("_at.char_end").alias("to"))
    return source_parts(placed, pieces).drop("piece", "from", "to")


def check_objects(objects: DataFrame, pieces: DataFrame, types: DataFrame, letter: str = T.ARABIC) -> DataFrame:
    """Every reason against every object; objects(unit_id, object, type, statement, said_by, basis, inference_reason, evidence).

    pieces(unit_id, piece_id, by, text), types(type). Returns (unit_id, object, statement, basis, reasons). Reasons keep the
    order of the checks, those of evidence the order of the evidence.
    """
    evidence = objects.select("unit_id", "object", F.col("said_by.kind").alias("kind"), F.posexplode("evidence").alias("k", "e")).select("unit_id", "object", "kind", "k", "e.piece", "e.quote")
    placed = place_quotes(evidence, pieces)
    why = (
        F.when(F.col("known").isNull(), "E_PIECE")
        .when(letters(F.coalesce("quote", F.lit("")), letter) < MIN_QUOTE_LETTERS, "E_QUOTE_SHORT")
        .when(F.col("place").isNull(), "E_QUOTE_NOT_FOUND")
        .when(F.col("kind").isin(*EDITOR_VOICE) & (F.col("by") != "editor"), "E_SPEAKER_ROLE")
        .when(F.col("kind").isin(*AUTHOR_VOICE) & (F.col("by") != "author"), "E_SPEAKER_ROLE")
    )
    of_evidence = placed.withColumn("why", why).groupBy("unit_id", "object").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("why").isNotNull(), F.struct("k", "why")))), lambda x: x["why"]).alias("of_evidence"))
    author = pieces.where("by = 'author'").groupBy("unit_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_id", "text"))), lambda x: x["text"]), " ").alias("author_text"))
    named = T.QUOTE.apply(F.coalesce("said_by.name_in_text", F.lit("")))
    ok_type = types.select("type", F.lit(True).alias("ok_type")).distinct()
    rows = objects.join(ok_type, "type", "left").join(of_evidence, ["unit_id", "object"], "left").join(author, "unit_id", "left")
    statement = F.coalesce("statement", F.lit(""))
    before = R.reasons([
        ("E_TYPE", F.col("ok_type").isNull()),
        ("E_STATEMENT", blank(statement) | (letters(statement, letter) == 0) | (F.length(statement) > MAX_STATEMENT)),
        ("E_BASIS", ~F.coalesce(F.col("basis").isin(*CONFIDENCE), F.lit(False)) | ((F.col("basis") == "inferred") & blank(F.col("inference_reason")))),
        ("E_SPEAKER_KIND", ~F.coalesce(F.col("said_by.kind").isin(*SPEAKERS), F.lit(False))),
        ("E_NO_EVIDENCE", F.coalesce(F.size("evidence"), F.lit(0)) <= 0),
    ])
    after = R.reasons([("E_NAME_NOT_IN_TEXT", F.coalesce(F.col("said_by.kind").isin(*NAME_REQUIRED), F.lit(False)) & ((named == "") | ~F.contains(T.QUOTE.apply(F.coalesce("author_text", F.lit(""))), named)))])
    return rows.select("unit_id", "object", "statement", "basis", F.concat(before, F.coalesce("of_evidence", F.array().cast("array<string>")), after).alias("reasons"))


def accept(checked: DataFrame, sheets: DataFrame) -> DataFrame:
    """Accepted objects with id, confidence and whether an accepted one of the unit says the same; sheets(unit_id, confidence)."""
    good = checked.where(F.size("reasons") == 0).withColumn("said", T.QUOTE.apply(F.col("statement")))
    order = Window.partitionBy("unit_id").orderBy("object")
    base = F.when(F.col("basis") == "explicit", CONFIDENCE["explicit"]).otherwise(CONFIDENCE["inferred"])
    marked = R.repeats(good, ["unit_id"], ["said"], ["object"]).join(sheets.select("unit_id", F.col("confidence").alias("_sheet")), "unit_id", "left")
    number = F.format_string("ko_%s_%02d", F.col("unit_id"), F.row_number().over(order))
    return marked.select(number.alias("id"), "unit_id", "object", "statement", R.least_confidence(base, F.col("_sheet")).alias("confidence"), "repeat")


#: What accepted objects are until someone has read them: a fixed value.
STATUS = "experimental"


def outcome(gated: DataFrame, checked: DataFrame, accepted: DataFrame, pieces: DataFrame) -> DataFrame:
    """(unit_id, info, objects, rejected): what became of every unit's draft, as the fields of knowledge_objects.json.

    gated, checked and accepted are of draft_reasons, check_objects and accept. info counts what was accepted and rejected (a draft
    that fails as a whole rejects all its objects, or itself if it has none; a missing or unreadable one has none) and has the reason for no knowledge.
    Evidence has its quote's parts in the source and the first and last place and page. Units are rows, so no task sees them all.
    """
    own = gated.where(F.size("reasons") == 0).select("unit_id", F.col("draft.model_used").alias("model_used"), F.posexplode("draft.objects").alias("object", "o"))
    quotes = own.select("unit_id", "object", F.posexplode("o.evidence").alias("k", "e")).select("unit_id", "object", "k", "e.piece", "e.quote")
    part = F.struct("char_start", "char_end", "role", "page")
    parts = quoted_parts(quotes, pieces).groupBy("unit_id", "object", "k").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    first, last = F.col("parts")[0], F.element_at("parts", -1)
    one = F.struct("piece", "quote", first["char_start"].alias("char_start"), last["char_end"].alias("char_end"), first["role"].alias("role"), first["page"].alias("page"), last["page"].alias("page_end"), "parts")
    evidence = quotes.join(parts, ["unit_id", "object", "k"], "left").groupBy("unit_id", "object").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", one.alias("x")))), lambda e: e["x"]).alias("evidence"))
    good = accepted.join(own, ["unit_id", "object"]).join(evidence, ["unit_id", "object"], "left")
    warnings = F.when(F.col("repeat"), F.array(F.lit("W_DUPLICATE"))).otherwise(F.array().cast("array<string>"))
    said = F.struct(
        "id", "unit_id", F.col("o.type").alias("type"), F.trim("statement").alias("statement"), F.col("o.said_by").alias("said_by"), F.col("o.basis").alias("basis"), F.when(F.col("o.basis") == "inferred", F.col("o.inference_reason")).alias("inference_reason"),
        "evidence", "confidence", "model_used", F.lit(PROMPT_VERSION).alias("prompt_version"), F.lit(STATUS).alias("status"), warnings.alias("warnings"),
    )
    objects = good.groupBy("unit_id").agg(F.array_sort(F.collect_list(F.struct("object", said.alias("x")))).alias("objects"))
    failed = checked.where(F.size("reasons") > 0).select("unit_id", "object", "statement", "reasons")
    whole = gated.where(F.size("reasons") > 0).select("unit_id", F.lit(None).cast("int").alias("object"), F.lit(None).cast("string").alias("statement"), "reasons")
    rejected = failed.unionByName(whole).groupBy("unit_id").agg(F.array_sort(F.collect_list(F.struct("object", "unit_id", "statement", "reasons"))).alias("rejected"))
    rows = gated.join(objects, "unit_id", "left").join(rejected, "unit_id", "left")
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    unread = F.arrays_overlap("reasons", F.array(F.lit("E_NO_SHEET"), F.lit("E_MISSING_DRAFT"), F.lit("E_JSON")))
    lost = F.when(F.size("reasons") == 0, size("rejected")).when(unread, 0).otherwise(F.greatest(F.col("n_objects"), F.lit(1)))
    info = F.struct(size("objects").alias("accepted"), lost.alias("rejected"), F.when(F.size("reasons") == 0, F.col("draft.no_knowledge_reason")).alias("no_knowledge_reason"))
    return rows.select("unit_id", info.alias("info"), F.transform(F.coalesce("objects", F.array().cast(objects.schema["objects"].dataType)), lambda x: x["x"]).alias("objects"), F.coalesce("rejected", F.array().cast(rejected.schema["rejected"].dataType)).alias("rejected"))


def outcome_file(found: DataFrame) -> DataFrame:
    """(name, content): knowledge_objects.json of one book's units, which are few enough for one file."""
    listed = F.array_sort(F.collect_list(F.struct("unit_id", "info", "objects", "rejected"))).alias("units")
    units = found.agg(listed)
    of = lambda c: F.flatten(F.transform("units", lambda u: u[c])).alias(c)
    per_unit = F.map_from_entries(F.transform("units", lambda u: F.struct(u["unit_id"], u["info"]))).alias("per_unit")
    body = F.struct(F.lit(PROMPT_VERSION).alias("prompt_version"), F.transform("units", lambda u: u["unit_id"]).alias("units_checked"), per_unit, of("objects"), of("rejected"))
    return units.select(F.lit("knowledge_objects.json").alias("name"), F.to_json(body).alias("content"))
