"""Validators of JSON documents: the first reason for which one is refused, or null.

Documents are read as VARIANT, so a missing field, an explicit null and a value of
another type are told apart without a schema.  The sentences are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.sqlparts import let, lit

BLOCK_TYPES = ("title", "verse", "prayer", "instruction", "ornament")
COLOURS = ("red", "black")
CATEGORIES = ("Caption", "Footnote", "Formula", "List-item", "Page-footer", "Page-header", "Picture", "Section-header", "Table", "Text", "Title")
#: Review lists of a transcript and the texts that an entry must have.
LISTS = {"corrections": ("printed", "suggested", "reason"), "uncertain": ("text", "why"), "clipped": ("edge", "note")}
MOST_BLOCKS, MOST_CELLS, MOST_BODY = 1000, 2000, 8 * 1024 * 1024


def _kind(v: str, field: str | None = None) -> str:
    """SQL: OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, VOID (an explicit null), or null where the field is missing."""
    at = f"try_variant_get({v}, '$.{field}', 'variant')" if field else v
    return f"regexp_extract(schema_of_variant({at}), '^[A-Z]+', 0)"


def _text(v: str, field: str) -> str:
    return f"try_variant_get({v}, '$.{field}', 'string')"


def _items(v: str, field: str | None = None) -> str:
    """SQL: the elements of an array, or of none where it is no array."""
    at = f"'$.{field}'" if field else "'$'"
    return f"coalesce(try_variant_get({v}, {at}, 'array<variant>'), cast(array() as array<variant>))"


def _is(v: str, field: str | None, kind: str) -> str:
    return f"coalesce({_kind(v, field)} = '{kind}', false)"


def _one_of(value: str, names) -> str:
    return f"coalesce({value} in ({', '.join(lit(n) for n in names)}), false)"


def _first(items: str, name: str, error: str) -> str:
    """SQL: the first error of the items (index i), or null."""
    return f"try_element_at(filter(transform({items}, ({name}, i) -> {error}), e -> e is not null), 1)"


def transcript_error(raw: str = "raw_json", page: str = "page", legacy: bool = False) -> Column:
    """Why a stored transcript of a page is refused. In legacy files the review lists may be missing, but not be anything else."""
    span = f"not ({_is('s', None, 'OBJECT')} and {_is('s', 't', 'STRING')} and {_is('s', 'c', 'STRING')} and {_one_of(_text('s', 'c'), COLOURS)})"
    block = f"""case when not ({_is('b', None, 'OBJECT')} and {_is('b', 'type', 'STRING')} and {_one_of(_text('b', 'type'), BLOCK_TYPES)}) then 'invalid block type'
        when coalesce({_kind('b', 'verse_num_am')}, 'STRING') <> 'STRING' then 'verse number must be a string'
        when not {_is('b', 'spans', 'ARRAY')} then 'spans must be an array'
        when exists({_items('b', 'spans')}, s -> {span}) then 'invalid text/colour span' end"""
    lists = []
    for name, fields in LISTS.items():
        bad = " or ".join(f"not {_is('x', f, 'STRING')}" for f in fields)
        missing = f"{_kind('v', name)} is null" if legacy else "false"
        lists.append(f"when {missing} then null when not {_is('v', name, 'ARRAY')} then '{name} must be an array' when exists({_items('v', name)}, x -> not {_is('x', None, 'OBJECT')} or {bad}) then 'invalid {name} entry'")
    fields = ", ".join(f"case {x} end" for x in lists)
    number = f"case when {_kind('v', 'page')} in ('BIGINT', 'DECIMAL', 'DOUBLE') then try_variant_get(v, '$.page', 'double') when {_kind('v', 'page')} = 'BOOLEAN' then cast(try_variant_get(v, '$.page', 'boolean') as int) end"
    body = f"""case when v is null or not {_is('v', None, 'OBJECT')} or {page} is null or {page} < 1 then 'invalid transcript or page number'
        when not coalesce({number} = {page}, false) then 'transcript page does not match its filename'
        when not {_is('v', 'blocks', 'ARRAY')} or size({_items('v', 'blocks')}) > {MOST_BLOCKS} then 'blocks must be an array with at most {MOST_BLOCKS} entries'
        else coalesce({_first(_items('v', 'blocks'), 'b', block)}, case when coalesce({_kind('v', 'notes')}, 'STRING') <> 'STRING' then 'notes must be text' end, {fields}) end"""
    return F.expr(let(f"try_parse_json({raw})", "v", body))


def hosted_error(raw: str = "body", page: str = "page", most: str = "max_page") -> Column:
    """Why a transcript sent to the hosted store is refused; page as it stands in the request (text)."""
    n = "cast(i + 1 as string)"
    # Fields of anything but an object read as missing, so arrays in place of objects fail below.
    span = f"""case when {_kind('s')} not in ('OBJECT', 'ARRAY') or not {_is('s', 't', 'STRING')} then concat('invalid span ', cast(j + 1 as string), ' in block ', {n})
        when length({_text('s', 't')}) > 100000 or not ({_is('s', 'c', 'STRING')} and {_one_of(_text('s', 'c'), COLOURS)}) then concat('invalid span ', cast(j + 1 as string), ' in block ', {n}) end"""
    spans = f"try_element_at(filter(transform({_items('b', 'spans')}, (s, j) -> {span}), e -> e is not null), 1)"
    block = f"""case when not {_is('b', None, 'OBJECT')} then concat('block ', {n}, ' must be an object')
        when not ({_is('b', 'type', 'STRING')} and {_one_of(_text('b', 'type'), BLOCK_TYPES)}) then concat('invalid type in block ', {n})
        when not {_is('b', 'verse_num_am', 'STRING')} or length({_text('b', 'verse_num_am')}) > 100 then concat('invalid verse number in block ', {n})
        when not {_is('b', 'spans', 'ARRAY')} or size({_items('b', 'spans')}) > 5000 then concat('invalid spans in block ', {n})
        else {spans} end"""
    given = lambda f: f"coalesce({_kind('v', f)}, 'VOID')"
    lists = ", ".join(f"case when {given(f)} not in ('VOID', 'ARRAY') then concat(chr(39), '{f}', chr(39), ' must be an array') when size({_items('v', f)}) > 2000 then concat(chr(39), '{f}', chr(39), ' contains too many items') end" for f in LISTS)
    body = f"""case when not {_is('v', None, 'OBJECT')} then 'expected a JSON object'
        when not {_is('v', 'blocks', 'ARRAY')} or size({_items('v', 'blocks')}) > {MOST_BLOCKS} then concat('expected a ', chr(39), 'blocks', chr(39), ' array with at most {MOST_BLOCKS} blocks')
        else coalesce({_first(_items('v', 'blocks'), 'b', block)}, case when {given('notes')} not in ('VOID', 'STRING') or length({_text('v', 'notes')}) > 100000 then 'invalid notes' end, {lists}) end"""
    sent = f"case when {body_error(raw)} is not null then {body_error(raw)} else {let(f'try_parse_json({raw})', 'v', body)} end"
    return F.coalesce(page_error(F.col(page), F.col(most)), F.expr(sent))


def whole_json(raw: str) -> str:
    """SQL: whether a text is one JSON value and nothing after it, which parse_json alone does not see.

    In a list before a word that the text cannot hold, its hash, the value must be followed by that word.
    """
    listed = f"""try_parse_json(concat('[', {raw}, ',"', md5({raw}), '"]'))"""
    return f"coalesce(try_variant_get({listed}, '$[1]', 'string') = md5({raw}), false)"


def body_error(raw: str = "body") -> str:
    """SQL: why a request's body is refused before it is looked at: empty, over MOST_BODY bytes, or no JSON; null for one that is read."""
    return f"case when {raw} is null or {raw} = '' or octet_length({raw}) > {MOST_BODY} then 'request body is empty or too large' when not {whole_json(raw)} then 'request body is not valid JSON' end"


def page_error(page: Column, most: Column) -> Column:
    """Why a page number in a request is refused: one to four digits, within the book."""
    digits = page.rlike(r"^[0-9]{1,4}\z")
    number = F.when(digits, page.cast("int"))
    return F.when(~F.coalesce(digits, F.lit(False)), "page must be a number").when((number < 1) | (number > most), F.concat(F.lit("page must be between 1 and "), most.cast("string")))


def review_entries(entries: DataFrame, page: str = "page", raw: str = "raw_json", most: str = "max_page") -> DataFrame:
    """entries (page as text, raw_json of a decision, max_page) with reason, status and stripped note; unknown fields are dropped."""
    v = entries.withColumn("_v", F.expr(f"try_parse_json({raw})"))
    kind = lambda f: F.expr(f"coalesce({_kind('_v', f)}, 'VOID')")
    value = lambda f: F.when(kind(f) == "STRING", F.expr(_text("_v", f)))
    n = F.col(page).cast("int").cast("string")
    bad_status = ~((kind("status") == "VOID") | F.coalesce(value("status").isin("approved", "needs_fix"), F.lit(False)))
    bad_note = ~kind("note").isin("VOID", "STRING") | (F.length(F.coalesce(value("note"), F.lit(""))) > 4000)
    reason = F.coalesce(
        page_error(F.col(page), F.col(most)),
        F.when(~F.expr(_is("_v", None, "OBJECT")), F.concat(F.lit("review entry "), n, F.lit(" must be an object"))),
        F.when(bad_status, F.concat(F.lit("invalid status for page "), n)),
        F.when(bad_note, F.concat(F.lit("note for page "), n, F.lit(" must be at most 4000 characters"))),
    )
    v = v.withColumn("reason", reason).withColumn("status", value("status")).withColumn("note", tx.strip(F.coalesce(value("note"), F.lit(""))))
    return v.drop("_v")


def layouts(pages: DataFrame, page: str = "page", raw: str = "content") -> DataFrame:
    """page, reason, cells of a model's answer (JSON text); original and sent: struct(w, h) of the image.

    One bad region refuses the page, nothing is mended; the first reason in the
    order of regions counts.  Boxes come out in the original's coordinates.
    """
    number = f"{_kind('x')} in ('BIGINT', 'DECIMAL', 'DOUBLE')"
    cell = f"""named_struct('object', {_is('c', None, 'OBJECT')}, 'category', case when {_is('c', 'category', 'STRING')} then {_text('c', 'category')} end,
        'numbers', {_is('c', 'bbox', 'ARRAY')} and size({_items('c', 'bbox')}) = 4 and forall({_items('c', 'bbox')}, x -> coalesce({number}, false)),
        'box', transform({_items('c', 'bbox')}, x -> try_variant_get(x, '$', 'double')),
        'text', case when {_kind('c', 'text')} is null then '' when {_is('c', 'text', 'STRING')} then {_text('c', 'text')} end)"""
    signature = "named_struct('b', c.box, 'c', c.category, 't', c.text)"
    error = f"""case when not c.object or not {_one_of('c.category', CATEGORIES)} then 'invalid layout category'
        when not c.numbers or exists(c.box, x -> x is null or isnan(x) or abs(x) = double('infinity')) then 'invalid bounding box'
        when not (0 <= c.box[0] and c.box[0] < c.box[2] and c.box[2] <= sent.w and 0 <= c.box[1] and c.box[1] < c.box[3] and c.box[3] <= sent.h) then 'bounding box lies outside the submitted image'
        when c.text is null or (c.category <> 'Picture' and btrim(c.text, {lit(tx.SPACES)}) = '') then 'text region contains no text'
        when array_position(transform(_cells, c -> {signature}), {signature}) <= i then 'duplicate layout region' end"""
    v = pages.withColumn("_v", F.expr(f"try_parse_json({raw})"))
    v = v.withColumn("_cells", F.expr(f"transform({_items('_v')}, c -> {cell})"))
    whole = F.when(~F.expr(_is("_v", None, "ARRAY")) | (F.size("_cells") == 0) | (F.size("_cells") > MOST_CELLS), f"expected a nonempty layout array with at most {MOST_CELLS} regions")
    reason = F.coalesce(whole, F.expr(_first("_cells", "c", error)))
    scaled = """transform(_cells, (c, i) -> named_struct('ord', i, 'category', c.category, 'text', c.text,
        'x1', c.box[0] * original.w / sent.w, 'y1', c.box[1] * original.h / sent.h, 'x2', c.box[2] * original.w / sent.w, 'y2', c.box[3] * original.h / sent.h))"""
    return v.withColumn("reason", reason).select(page, "reason", F.when(F.col("reason").isNull(), F.expr(scaled)).alias("cells"))


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, copies: keys that more than one row has; null keys are equal. No rows where keys are unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def known_books(ids: DataFrame, registry: DataFrame, key: str = "book_id") -> DataFrame:
    """ids with reason: a book that is not in the registry is unknown."""
    have = registry.select(F.col(key).alias("_k"), "max_page")
    return ids.join(have, F.col(key) == F.col("_k"), "left").withColumn("reason", F.when(F.col("_k").isNull(), "unknown book")).drop("_k")
