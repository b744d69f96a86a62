"""Line deduplication with a log-template tree of fixed depth.

A line descends by its number of tokens and by its leading tokens, with runs of digits generalised first. In the leaf its
other fields are generalised by position: tokens are counted by (leaf, position), and a position whose token fewer than
`min_docs` lines share, or lines of one document only, becomes a wildcard. What is left, if it is most of the line and
has tokens enough for a line of its own, is its template, so `Posted by Anna in Garden news` and `Posted by Ben in Sports news` meet. Lines of more than `PLACED_TOKENS`
tokens are generalised by halves instead: one half constant, the other a wildcard. Templates, and whole lines, found in
`min_docs` documents recur, and the lines under them are dropped from all documents but the first that has them, so that
no text is lost altogether.

Copies of a document would make all its lines recur. Documents are therefore told apart by their whole text: exact
copies count as one, all other documents count each. A line of `LONG_TOKENS` tokens or more is no boilerplate by
chance: it recurs from two documents on, if it is the same word for word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tapeglass.llm.common import staged, unused

MIN_DOCS = 3
#: Lines of so many tokens have templates, or of so many characters if they have fewer tokens.
MIN_TOKENS = 4
MIN_CHARS = 20
LEADING = 2
#: Lines of up to so many tokens are generalised position by position, longer ones by halves.
PLACED_TOKENS = 16
#: Share of a line's tokens that its template must hold.
CONSTANT_SHARE = 0.6
#: Lines of at least this many tokens recur from LONG_DOCS documents on, if they are the same word for word.
LONG_TOKENS = 50
LONG_DOCS = 2


def _plain_lines(text: Column) -> Column:
    """The lines of a text with runs of digits as <*> and one space between tokens."""
    generalised = F.transform(F.split(text, "\n"), lambda line: F.regexp_replace(line, "[0-9]+", "<*>"))

    def spaced(line: Column) -> Column:
        uneven = line.contains("  ") | line.contains("\t") | line.contains("\r")
        return F.trim(F.when(uneven, F.regexp_replace(line, "[ \\t\\r]+", " ")).otherwise(line))

    return F.transform(generalised, spaced)


def _size(plain: Column) -> Column:
    """Number of tokens; an empty line counts as one."""
    return F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(" "), F.lit(""))) + 1


def _whole(plain: Column) -> Column:
    """Hash of the line; equal ones share all templates."""
    return F.xxhash64(F.lit("whole"), plain)


def _halves(plain: Column, size: Column) -> Column:
    """Hashes of the templates with one constant half, below the leaf of token count and leading tokens."""

    def tokens(count: Column) -> Column:
        """So many tokens from the front, or from the back if negative."""
        return F.call_function("substring_index", plain, F.lit(" "), count)

    half = F.floor(size / 2).cast("int")
    lead = tokens(F.lit(LEADING))
    return F.array(F.xxhash64(F.lit("first"), size, lead, tokens(half)), F.xxhash64(F.lit("second"), size, lead, tokens(half - size)))


def _lines(docs: DataFrame, min_tokens: int, key: str, text: str) -> DataFrame:
    """(key, document, whole, size, tokens, halves): a row per line with templates. `tokens` holds hashes of the tokens of
    lines that are generalised by position, `halves` the templates of longer ones.

    Staged, since templates are counted first and then looked up.
    """
    plain = F.col("plain")
    cut = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("document"), F.explode(_plain_lines(F.col(text))).alias("plain"))
    sized = cut.withColumn("size", _size(plain)).where((F.col("size") >= min_tokens) | (F.char_length(plain) >= MIN_CHARS))
    placed = F.col("size").between(min_tokens, PLACED_TOKENS)
    tokens = F.when(placed, F.transform(F.split(plain, " "), lambda token: F.xxhash64(token)))
    halves = F.when(F.col("size") > PLACED_TOKENS, _halves(plain, F.col("size")))
    return staged(sized.select("key", "document", _whole(plain).alias("whole"), "size", tokens.alias("tokens"), halves.alias("halves")), "lines")


def _placed(lines: DataFrame, min_docs: int, min_tokens: int) -> DataFrame:
    """(whole, template): the template of a line whose tokens are generalised by position, if it is not the line itself."""
    leaf = F.concat(F.array(F.col("size").cast("long")), F.slice("tokens", 1, LEADING))
    short = lines.where("tokens IS NOT NULL")
    values = short.select("whole", "document", F.xxhash64(leaf).alias("leaf"), F.posexplode("tokens").alias("at", "token"))
    values = values.select("whole", "document", "at", F.xxhash64("leaf", "at", "token").alias("value"))
    counts = values.groupBy("value").agg(F.count(F.lit(1)).alias("lines"), F.min("document").alias("least"), F.max("document").alias("most"))
    constant = counts.where((F.col("lines") >= min_docs) & (F.col("least") != F.col("most"))).select("value")
    # A line's constant positions as bits, which copies of the line do not change.
    bit = F.call_function("shiftleft", F.lit(1), F.col("at"))
    masks = values.join(constant, "value").groupBy("whole").agg(F.bit_or(bit).alias("mask"))
    held, least = F.bit_count("mask"), F.greatest(F.lit(float(min_tokens)), CONSTANT_SHARE * F.col("size"))
    masks = masks.select(F.col("whole").alias("of"), "mask")
    found = short.select("whole", "size", "tokens", leaf.alias("leaf")).dropDuplicates(["whole"])
    found = found.join(masks, F.col("whole") == F.col("of")).where((held < F.col("size")) & (held >= least))
    kept = F.filter("tokens", lambda token, at: F.call_function("shiftright", F.col("mask"), at).bitwiseAND(1) == 1)
    return found.select("whole", F.xxhash64(F.lit("placed"), "leaf", "mask", kept).alias("template"))


def _under(lines: DataFrame, min_docs: int, min_tokens: int) -> DataFrame:
    """(key, document, whole, template, long): a row per line and template above it, the line itself included."""
    none = F.array().cast("array<bigint>")
    own = F.concat(F.array("whole"), F.coalesce("halves", none))
    plainly = lines.select("key", "document", "whole", "size", F.explode(own).alias("template"))
    long = (F.col("template") == F.col("whole")) & (F.col("size") >= LONG_TOKENS)
    # Staged, so that both sides of the join are read anew and a line of very many documents can be split.
    placed = staged(_placed(lines, min_docs, min_tokens), "placed-lines").withColumnRenamed("whole", "of")
    generalised = lines.where("tokens IS NOT NULL").select("key", "document", "whole").join(placed, F.col("whole") == F.col("of"))
    return plainly.select("key", "document", "whole", "template", long.alias("long")).unionByName(
        generalised.select("key", "document", "whole", "template", F.lit(False).alias("long"))
    )


def _recurring(under: DataFrame, min_docs: int) -> DataFrame:
    """(template, documents, first, keyless): the smallest key that has it, and whether a row without a key does."""
    apart = under.groupBy("template", "document").agg(
        F.min("key").alias("first"), F.bool_or(F.col("key").isNull()).alias("keyless"), F.bool_or("long").alias("long")
    )
    counted = apart.groupBy("template").agg(
        F.count(F.lit(1)).alias("documents"), F.min("first").alias("first"), F.bool_or("keyless").alias("keyless"), F.bool_or("long").alias("long")
    )
    enough = (F.col("documents") >= min_docs) | (F.col("long") & (F.col("documents") >= LONG_DOCS))
    return counted.where(enough).drop("long")


def recurring_templates(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(template, documents, first) of the templates found in at least `min_docs` documents that are no copies, or in two for
    a long line."""
    return _recurring(_under(_lines(docs, min_tokens, key, text), min_docs, min_tokens), min_docs).drop("keyless")


def without_recurring_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` with the recurring lines taken out of all texts but the first, and the number of lines taken out.

    The first document has the smallest key. A line stays in it if it is the first for all templates of the line.

    All columns stay; `dropped_lines` (long) is added, in place of a column of that name. Texts without a recurring
    line, NULL and empty ones included, are unchanged; a text of nothing else becomes empty. Rows with the same key
    are one document, rows with a NULL key one that comes first; repeated rows are all kept. An empty table gives no
    rows.
    """
    drops_key, dropped, kept_lines = (unused(docs, name) for name in ("drops_key", "dropped_hashes", "kept_lines"))
    lines = _lines(docs, min_tokens, key, text)
    under = _under(lines, min_docs, min_tokens)
    templates = _recurring(under, min_docs).drop("documents")
    later = F.col("key").isNotNull() & (F.col("keyless") | (F.col("key") != F.col("first")))
    drops = (
        under.select("key", "whole", "template")
        .join(templates, "template")
        .where(later)
        .groupBy(F.col("key").alias(drops_key))
        .agg(F.collect_set("whole").alias(dropped))
    )
    joined = docs.join(drops, F.col(key).eqNullSafe(F.col(drops_key)), "left").drop(drops_key)
    own = F.split(F.col(text), "\n")
    pairs = F.arrays_zip(own.alias("line"), F.transform(_plain_lines(F.col(text)), _whole).alias("whole"))
    kept = F.filter(pairs, lambda pair: ~F.array_contains(F.col(dropped), pair["whole"]))
    changed = joined.withColumn(kept_lines, F.when(F.col(dropped).isNotNull(), F.transform(kept, lambda pair: pair["line"])))
    return changed.withColumns({
        "dropped_lines": F.coalesce(F.size(own) - F.size(kept_lines), F.lit(0)).cast("long"),
        text: F.when(F.col(kept_lines).isNull(), F.col(text)).otherwise(F.array_join(kept_lines, "\n")),
    }).drop(dropped, kept_lines)
