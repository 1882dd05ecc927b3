"""Reading sheets of units: what a drafter sees of a unit, piece by piece, with the way back into the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.operators import validate as V

#: Roles that are no main text, roles of footnotes, and the settings of a sheet: fixed values.
NOTE_ROLES = ("takhrij", "gharib", "footnote")
HEADING_ROLES = ("heading", "subtitle")
NO_MAIN_TEXT = (*HEADING_ROLES, "number", "anchor", "source_attribution", *NOTE_ROLES, "noise_ref")
DEFAULTS = {"heading_by": "editor", "main_text_by": "author", "footnote_roles": {"gharib": "include", "takhrij": "exclude", "footnote": "include"}}
RANKS = {"heading": 0, "main": 1, "attribution": 2, "footnote": 3}


def marker_of(text: Column, pattern: str = r"^\s*(\([^)]{1,4}\))") -> Column:
    """The marker that opens a footnote's text; empty if there is none."""
    return F.coalesce(F.regexp_extract(text, pattern, 1), F.lit(""))


def chosen(units: DataFrame, wanted: DataFrame | None, key: str = "id") -> tuple[DataFrame, DataFrame | None]:
    """(units that are wanted, wanted keys that no unit has); all units, and None, if nothing is asked for."""
    if wanted is None:
        return units, None
    asked = wanted.select(F.col(wanted.columns[0]).alias(key)).where(F.col(key).isNotNull()).distinct()
    return units.join(asked, key, "left_semi"), asked.join(units.select(key), key, "left_anti")


def pieces(built: DataFrame, books: DataFrame, settings: dict | None = None) -> DataFrame:
    """(book_id, unit_id, piece_id, kind, by, label, text, spans): a unit's segments gathered by kind, footnotes by id and role.

    Pieces come in order of kind and then of their first segment; segments are joined by one space, line ends become
    spaces, and spans tells for each where it begins in the piece and where it stands in the source. Segments of other
    kinds, and footnotes whose role is not to be included, are left out.
    """
    rules = {**DEFAULTS, **(settings or {})}
    included = [r for r in NOTE_ROLES if (rules["footnote_roles"] or {}).get(r, "exclude") == "include"]
    segments = V.relation(built, "segment").where("kind = 'unit'").select("book_id", F.col("owner").alias("unit_id"), "role", "char_start", "char_end", "page", F.coalesce("ref", F.lit("?")).alias("fn"), "note")
    role = F.col("role")
    kind = F.when(role.isin(*HEADING_ROLES), "heading").when(role == "source_attribution", "attribution").when(role.isin(*NOTE_ROLES), F.when(role.isin(*included), "footnote") if included else None).when(~role.isin(*NO_MAIN_TEXT), "main")
    own = V.with_text(segments.withColumn("kind", kind).where("kind is not null"), books)
    group = F.when(F.col("kind") == "footnote", F.concat_ws(":", "fn", "role")).otherwise("")
    part = F.struct("char_start", "char_end", "role", "page", F.regexp_replace("span_text", "\n", " ").alias("part"))
    gathered = own.groupBy("book_id", "unit_id", "kind", group.alias("group")).agg(F.array_sort(F.collect_list(part)).alias("parts"), F.min_by("role", "char_start").alias("role"), F.min_by("note", "char_start").alias("note"))
    rank = F.element_at(F.create_map(*[F.lit(x) for pair in RANKS.items() for x in pair]), F.col("kind"))
    by_unit = Window.partitionBy("book_id", "unit_id").orderBy("rank", "first", "group")
    ordered = gathered.withColumn("rank", rank).withColumn("first", F.col("parts")[0]["char_start"]).withColumn("piece_id", F.format_string("p%02d", F.row_number().over(by_unit)))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<piece_start:int,char_start:int,char_end:int,role:string,page:int>>").alias("out"))
    step = lambda acc, x: F.struct((acc["at"] + F.length(x["part"]) + 1).alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("piece_start"), x["char_start"].alias("char_start"), x["char_end"].alias("char_end"), x["role"].alias("role"), x["page"].alias("page")))).alias("out"))
    label = F.when(F.col("kind") == "heading", "heading").when(F.col("kind") == "main", "main text").when(F.col("kind") == "attribution", "source attribution").otherwise(F.regexp_replace(F.concat(F.lit("footnote "), marker_of(F.col("note")), F.lit(" ("), "role", F.lit(")")), "  ", " "))
    by = F.when(F.col("kind") == "heading", rules["heading_by"]).when(F.col("kind") == "main", rules["main_text_by"]).when(F.col("kind") == "attribution", "author").otherwise("editor")
    return ordered.select("book_id", "unit_id", "piece_id", "kind", by.alias("by"), label.alias("label"), F.array_join(F.transform("parts", lambda x: x["part"]), " ").alias("text"), F.aggregate("parts", begin, step)["out"].alias("spans"))


def sheets(built: DataFrame, pieces_: DataFrame) -> DataFrame:
    """(book_id, unit_id, json, markdown): the two files of every unit's sheet; units without pieces have sheets too."""
    fields = ("piece_id", "kind", "by", "label", "text", "spans")
    each = F.array_sort(F.collect_list(F.struct(*fields)))
    own = pieces_.groupBy("book_id", "unit_id").agg(each.alias("pieces"))
    units = V.relation(built, "unit").select("book_id", F.col("id").alias("unit_id"), F.col("kind").alias("type"), "ordinal", "confidence")
    met = units.join(own, ["book_id", "unit_id"], "left").withColumn("pieces", F.coalesce("pieces", F.array().cast(own.schema["pieces"].dataType)))
    as_json = F.to_json(F.struct("unit_id", "type", "ordinal", "confidence", F.transform("pieces", lambda p: F.struct(p["piece_id"].alias("id"), *[p[f].alias(f) for f in fields[1:]])).alias("pieces")))
    who = lambda p: F.when(p["by"] == "author", "the AUTHOR's text").otherwise("the EDITOR's words")
    more = lambda p: F.when(p["kind"] == "main", " (it may report the words of others: the Prophet ﷺ, a verse, a quoted person)").otherwise("")
    lines = F.flatten(F.transform("pieces", lambda p: F.array(F.concat(F.lit("["), p["piece_id"], F.lit("] "), p["label"], F.lit(" — "), who(p), more(p)), F.trim(p["text"]), F.lit(""))))
    head = F.array(F.concat(F.lit("UNIT "), "unit_id", F.lit("  ("), "type", F.lit(" "), F.col("ordinal").cast("string"), F.lit(")")), F.lit(""))
    return met.select("book_id", "unit_id", as_json.alias("json"), F.array_join(F.concat(head, lines), "\n").alias("markdown"))


def source_parts(placed: DataFrame, pieces_: DataFrame) -> DataFrame:
    """Quotes placed in their piece, cut at its segments: (keys of placed, char_start, char_end, role, page), in order of the source.

    placed(unit_id, piece, from, to, ...) has the quote's place in the piece's text; a quote over several segments
    has a row for each.
    """
    span = pieces_.select("unit_id", F.col("piece_id").alias("piece"), F.explode("spans").alias("x"))
    size = F.col("x.char_end") - F.col("x.char_start")
    lo, hi = F.greatest(F.col("from"), F.col("x.piece_start")), F.least(F.col("to"), F.col("x.piece_start") + size)
    met = placed.join(span, ["unit_id", "piece"]).withColumn("_lo", lo).withColumn("_hi", hi).where("_lo < _hi")
    shift = F.col("x.char_start") - F.col("x.piece_start")
    return met.select(*placed.columns, (F.col("_lo") + shift).alias("char_start"), (F.col("_hi") + shift).alias("char_end"), "x.role", "x.page")
