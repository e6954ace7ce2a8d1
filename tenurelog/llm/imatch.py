"""I-Match fingerprints over several randomised lexicons, by DataFrame functions only.

The lexicon holds the terms whose inverse document frequency lies in a band,
``ln(1 / MOST) <= ln(N / df) <= ln(1 / LEAST)``: neither everywhere nor rare. Document
frequencies are counted for ``2**BITS`` hash buckets of terms, so the lexicon is a bitmap
of a fixed size that goes into the plan as one constant. Rare terms together fill a
bucket to (mean number of distinct terms per document) / ``2**BITS`` of all documents,
far below ``LEAST`` however large the vocabulary; a rare term that shares its bucket
with one of the lexicon counts as in it, in every document alike.

A fingerprint has ``SUBSETS + 1`` parts: the hash of the sorted distinct lexicon
terms of the text, and the same for each random subset, which keeps one term in
``2**KEEP_BITS``. Few edits change few parts, so the share of equal parts is a
likeness. An empty part would equal that of any other text without such terms; it
repeats the first part instead, which without lexicon terms is a hash of all terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .workspace import ID, TEXT, texts

BITS = 20
LEAST, MOST = 0.005, 0.25
SUBSETS, KEEP_BITS = 12, 5
BUCKET_BYTES = 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SMALLEST = -(1 << 63)


def terms(text: Column) -> Column:
    """Hashes of the distinct terms: lower-cased runs of letters and digits."""
    found = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))
    return F.array_distinct(F.transform(found, lambda t: F.xxhash64(t)))


def constant_array(values: list[int]) -> Column:
    """An array of longs that the optimizer folds into one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


class Lexicon:
    """The buckets of terms in the band, as a bitmap of longs."""

    def __init__(self, base: DataFrame, least: float, most: float):
        buckets = F.array_distinct(F.transform(terms(F.coalesce(TEXT, F.lit(""))), self.bucket))
        counted = base.select(F.explode(buckets).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("df"))
        n = base.count()
        band = counted.where((F.col("df") >= least * n) & (F.col("df") <= most * n))
        words = band.groupBy(F.shiftright("bucket", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, bucket & 63))").alias("bits"))
        held = {r["word"]: r["bits"] for r in words.collect()}  # at most 2**BITS / 64
        self.table = constant_array([held.get(i, 0) for i in range(1 << (BITS - 6))])

    @staticmethod
    def bucket(term: Column) -> Column:
        return F.pmod(term, F.lit(1 << BITS)).cast("int")

    def holds(self, term: Column) -> Column:
        at = self.bucket(term)
        return F.getbit(F.get(self.table, F.shiftright(at, 6)), at.bitwiseAND(F.lit(63))) == 1


def parts(df: DataFrame, text: str, name: str, lexicon: Lexicon) -> DataFrame:
    """``df`` with the parts of the fingerprint of a text column, as an array of longs."""
    every, kept = f"_{name}_terms", f"_{name}_kept"
    df = df.withColumn(every, F.array_sort(terms(F.col(text))))
    df = df.withColumn(kept, F.filter(every, lexicon.holds))
    whole = F.when(F.size(every) > 0, F.xxhash64(every)).otherwise(F.xxhash64(text))

    def chosen_by(k: int):
        return lambda t: F.shiftright(t, k * KEEP_BITS).bitwiseAND(F.lit((1 << KEEP_BITS) - 1).cast("long")) == 0

    def part(number: int, chosen: Column, instead: Column) -> Column:
        return F.when(F.size(chosen) > 0, F.xxhash64(chosen)).otherwise(F.xxhash64(F.lit(number), instead))

    first = f"_{name}_first"
    df = df.withColumn(first, part(0, F.col(kept), whole))
    subsets = [part(k + 1, F.filter(kept, chosen_by(k)), F.col(first)) for k in range(SUBSETS)]
    return df.withColumn(name, F.array(F.col(first), *subsets)).drop(every, kept, first)


def as_text(column: str) -> Column:
    return F.array_join(F.transform(column, lambda x: F.lpad(F.hex(x), 16, "0")), "-")


def likeness(a: str, b: str) -> Column:
    equal = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(equal, F.lit(0), lambda n, x: n + x) / F.lit(float(SUBSETS + 1))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, most: float = MOST) -> DataFrame:
    """One row per document: id and ``fingerprint``.

    A NULL text counts as empty. Equal texts have equal fingerprints; texts
    without terms get one of their own bytes. Rows are independent of one another
    but for the lexicon, in which a repeated row counts again. Other columns are
    ignored; an empty table gives an empty result.
    """
    base = texts(docs, id_col, text_col).withColumn(TEXT, F.coalesce(TEXT, F.lit("")))
    done = parts(base, TEXT, "_parts", Lexicon(base, least, most))
    return done.select(F.col(ID).alias(id_col), as_text("_parts").alias("fingerprint"))


def with_next(rows: DataFrame, values: list[str], bucket_bytes: int) -> DataFrame:
    """Each row with the struct ``_next`` of the values of the row that follows by id; the first follows the last.

    Buckets of consecutive ids are cut at quantiles, so each is one window of
    about ``bucket_bytes`` of text. The first rows of a bucket also go to the one
    before it, where they serve as the successor of its last row only.
    """
    key = F.coalesce(F.col(ID).cast("long"), F.lit(SMALLEST))
    size, low = rows.agg(F.sum(F.octet_length(TEXT)), F.min(key)).first()
    wanted = max(1, (size or 0) // bucket_bytes)
    cuts = []
    if wanted > 1:
        shares = [i / wanted for i in range(1, wanted)]
        cuts = rows.agg(F.percentile_approx(key, shares, max(10_000, 20 * wanted))).first()[0]
    cuts = sorted({low if low is not None else SMALLEST, *cuts})

    # Number of cuts at or below the key, by binary search in a constant array.
    steps = len(cuts).bit_length()
    filled = constant_array(cuts + [(1 << 63) - 1] * ((1 << steps) - len(cuts)))
    search = F.lit(0)
    at = F.aggregate(
        constant_array([1 << s for s in reversed(range(steps))]).cast("array<int>"),
        search,
        lambda pos, step: F.when(F.element_at(filled, pos + step) <= F.col("_key"), pos + step).otherwise(pos),
    )
    last = len(cuts) - 1
    keyed = rows.withColumn("_key", key).withColumn("_bucket", F.least(at, F.lit(last + 1)) - 1)
    is_cut = F.element_at(filled, F.col("_bucket") + 1) == F.col("_key")
    own = F.struct(F.col("_bucket").alias("bucket"), F.lit(0).alias("turn"), F.lit(False).alias("guest"))
    # The very first rows visit the last bucket, behind all others.
    before = F.when(F.col("_bucket") == 0, F.lit(last)).otherwise(F.col("_bucket") - 1)
    guest = F.struct(before.alias("bucket"), F.when(F.col("_bucket") == 0, 1).otherwise(0).alias("turn"), F.lit(True).alias("guest"))
    seats = F.explode(F.when(is_cut, F.array(own, guest)).otherwise(F.array(own)))
    seated = keyed.withColumn("_seat", seats)
    order = Window.partitionBy("_seat.bucket").orderBy("_seat.turn", "_key", F.xxhash64(TEXT), TEXT)
    return seated.withColumn("_next", F.lead(F.struct(*values)).over(order)).where("NOT _seat.guest")


def edited_fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = LEAST,
    most: float = MOST,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Fingerprints of the documents and of texts edited from them, and how alike they are.

    The edited text has the last half of its code points (rounded down) replaced
    by as many first ones, or all, of the document that follows by id; the first
    follows the last. Ids must be integers; NULL counts as smallest, and rows with
    one id are taken in the order of a hash of their text and stay together.
    Otherwise as :func:`fingerprints`. Returns id, ``n_chars``, ``edited``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``.
    """
    base = texts(docs, id_col, text_col).withColumn(TEXT, F.coalesce(TEXT, F.lit("")))
    lexicon = Lexicon(base, least, most)
    rows = with_next(parts(base, TEXT, "_parts", lexicon), [TEXT, "_parts"], bucket_bytes)
    n = F.char_length(TEXT)
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(TEXT, F.lit(1), n - half), F.substring(f"_next.{TEXT}", F.lit(1), half))
    rows = rows.select(ID, n.cast("long").alias("n_chars"), "_parts", F.col("_next._parts").alias("_next_parts"), edited.alias("edited"))
    done = parts(rows, "edited", "_edited_parts", lexicon)
    return done.select(
        F.col(ID).alias(id_col),
        "n_chars",
        "edited",
        as_text("_parts").alias("fingerprint"),
        as_text("_edited_parts").alias("edited_fingerprint"),
        likeness("_parts", "_edited_parts").alias("near_edited"),
        likeness("_parts", "_next_parts").alias("near_next"),
    )
