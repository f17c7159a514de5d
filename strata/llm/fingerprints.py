"""Winnowed document fingerprints, with DataFrame functions only.

``rolled`` hashes the k-grams of characters (code points) from every place of the whole text on; ``chosen`` those of fields
(what spaces separate), by a polynomial over the fields' hashes modulo a prime. Of every ``window`` k-grams in a row the one
with the smallest hash is chosen, the rightmost of equals, and its position is kept: texts that share window + k - 1
characters (or fields) in a row share a chosen hash.

Defined cases: a null text is empty, and empty text is one empty field or character; a text with fewer than k is one k-gram;
rows with equal doc_id and text count as one document when the next document is looked up; a null doc_id comes last in
descending order; an empty table gives no rows. Columns other than doc_id and text are ignored. A text of any length is
marked stretch by stretch; its spelling, four bytes a character, is held in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written

PRIME = 2**31 - 1
BASE = 48_271
LAST = 2**31 - 1


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.get(F.transform(F.array(value), body), 0)


def chosen(text: Column, k: int = 3, window: int = 4) -> Column:
    """Array of hash * 2^31 + (2^31 - 1 - position) of the chosen k-grams. ``window`` is a power of two."""
    if window & (window - 1):
        raise ValueError("window must be a power of two")

    def grams(fields: Column) -> Column:
        def gram(i: Column) -> Column:
            value = F.get(fields, i)
            for j in range(1, k):
                value = (value * BASE + F.coalesce(F.get(fields, i + j), F.lit(0))) % PRIME
            return value * 2**31 + (LAST - i)

        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(fields) - k, F.lit(0))), gram)

    def halved(step: int):
        return lambda v: F.transform(v, lambda x, i: F.least(x, F.coalesce(F.get(v, i + step), x)))

    smallest = bound(F.transform(F.split(text, " "), lambda x: F.pmod(F.xxhash64(x), F.lit(PRIME))), grams)
    step = 1
    while step < window:
        smallest, step = bound(smallest, halved(step)), step * 2
    full = bound(smallest, lambda m: F.slice(m, F.lit(1), F.greatest(F.size(m) - (window - 1), F.lit(1))))
    return F.array_distinct(full)


def rolled(text: Column, k: int = 16, window: int = 32, stretch: int = 2**12) -> Column:
    """As ``chosen``, over k-grams of characters. ``window`` and ``stretch`` are powers of two.

    The text is spelled with four bytes a character, so a k-gram is a slice at a known place. Stretches of places are marked
    one after the other, each reading on into the next: what a text takes besides this spelling and its marks is the arrays
    of one stretch. Four (or two) neighbouring minima make the minimum of a window four times (twice) as long; a null beyond
    the end does not count.
    """
    if window & (window - 1) or stretch & (stretch - 1) or k < 1:
        raise ValueError("window and stretch must be powers of two, k at least 1")

    def least(step: int, times: int):
        return lambda v: F.transform(v, lambda x, i: F.least(x, *[F.get(v, i + j * step) for j in range(1, times)]))

    def marked(spelled: Column, last: Column, first: Column) -> Column:
        """Marks of the windows from place ``first`` on; the last k-gram lies at ``last``."""
        end = F.least(first + (stretch + window - 2), last)
        value = F.transform(
            F.sequence(first * 4 + 1, end * 4 + 1, F.lit(4)), lambda p: F.shiftright(F.xxhash64(F.substring(spelled, p, 4 * k)), 1).bitwiseOR(F.lit(LAST)) - p
        )
        step = 1
        while step < window:
            times = 4 if step * 4 <= window else 2
            value, step = bound(value, least(step, times)), step * times
        return F.array_distinct(bound(value, lambda m: F.slice(m, F.lit(1), F.greatest(F.size(m) - (window - 1), F.lit(1)))))

    def stretches(spelled: Column) -> Column:
        last = F.greatest(F.shiftright(F.octet_length(spelled), 2) - k, F.lit(0))
        firsts = F.sequence(F.lit(0), F.greatest(last - (window - 1), F.lit(0)), F.lit(stretch))
        return F.array_distinct(F.flatten(F.transform(firsts, lambda first: marked(spelled, last, first))))

    # so far a mark holds where its k-gram's bytes begin, counted from 1
    return F.transform(bound(F.encode(text, "UTF-32"), stretches), lambda x: x + positions_of(x) - F.shiftright(positions_of(x), 2))


def hashes(marks: Column) -> Column:
    return F.array_distinct(F.transform(marks, lambda x: F.shiftright(x, 31).cast("int")))


def positions_of(mark: Column) -> Column:
    return F.lit(LAST) - mark.bitwiseAND(F.lit(LAST))


def positions(marks: Column) -> Column:
    return F.transform(marks, positions_of)


def packed(marks: Column) -> list[Column]:
    """Marks for a shuffle, which packs the positions' high parts, long runs of equal numbers: hashes, low bytes, the rest."""
    low = F.transform(marks, lambda x: (positions_of(x).bitwiseAND(F.lit(255)) - 128).cast("tinyint"))
    high = F.transform(marks, lambda x: F.shiftright(positions_of(x), 8).cast("int"))
    return [F.transform(marks, lambda x: F.shiftright(x, 31).cast("int")), low, high]


def unpacked(hashed: Column, low: Column, high: Column) -> Column:
    def mark(x: Column, i: Column) -> Column:
        place = F.get(high, i).cast("long") * 256 + (F.get(low, i).cast("long") + 128)
        return x.cast("long") * 2**31 + (F.lit(LAST) - place)

    return F.transform(hashed, mark)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes."""
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def fingerprints(df: DataFrame, k: int = 3, window: int = 4, text: str = "text") -> DataFrame:
    """Adds ``marks``, of which ``hashes`` and ``positions`` are the parts."""
    return df.withColumn("marks", chosen(F.coalesce(F.col(text), F.lit("")), k, window))


def next_documents(ids: DataFrame) -> DataFrame:
    """The next (doc_id, tie) in descending order for each distinct one, the first after the last.

    Rows are dealt by range and written with their task's number; each task's last row takes the first of the next task
    that has rows, so no task sorts all ids.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie").desc()]
    dealt = written(ids.repartitionByRange(*order).withColumn("run", F.spark_partition_id()), "order")
    near = Window.partitionBy("run").orderBy(*order)
    row = F.struct("doc_id", "tie")
    inner = dealt.select("*", F.lead(row).over(near).alias("inner"), F.row_number().over(near).alias("place"))
    runs = inner.where("place = 1").select("run", row.alias("head"))
    after = Window.orderBy("run")
    everything = after.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = runs.select("run", F.coalesce(F.lead("head").over(after), F.first("head").over(everything)).alias("outer"))
    following = F.coalesce("inner", "outer")
    return inner.join(heads, "run").select(
        "doc_id", "tie", "n_chars", following["doc_id"].alias("next_id"), following["tie"].alias("next_tie")
    )


def edited_marks(marks: Column, head_marks: Column, edited: Column, cut: Column, head: Column, k: int, window: int) -> Column:
    """Marks of a text's first ``cut`` characters and ``head`` characters of another's: ``edited``.

    Windows that lie in one of both are those of its text: ``marks`` up to the last such window's place are taken over, and so
    are ``head_marks``, the other's. Hashed anew are the windows over the seam and those before either end that may choose a
    later place. A short head is hashed with the seam. The chosen places never go back, so distinct marks stay in order.
    """
    span = k + window - 1

    def anew(first: Column, n: Column) -> Column:
        return F.transform(rolled(F.substring(edited, first + 1, n), k, window), lambda x: x - first)

    short = head < 2 * span
    first = F.greatest(cut - (span + window - 2), F.lit(0))
    end = cut + head - (span + window - 2)
    seam = anew(first, F.when(short, cut + head).otherwise(cut + (span - 1)) - first)
    none = F.array().cast("array<bigint>")
    return F.array_distinct(
        F.concat(
            F.filter(marks, lambda x: positions_of(x) <= cut - span),
            seam,
            F.when(short, none).otherwise(F.transform(head_marks, lambda x: x - cut)),
            F.when(short, none).otherwise(anew(F.greatest(end, cut), F.lit(span + window - 2))),
        )
    )


def edited_fingerprints(docs: DataFrame, k: int = 16, window: int = 32) -> DataFrame:
    """Fingerprint of each text, and of its edit: the last third replaced by the start of the next document.

    Returns doc_id, text, n_chars, edited_text, the marks of both, and how like the document's hashes are to those of the
    edited text (near_edited) and of the next document (near_next). Each text is hashed once, before it is shuffled; of
    the edit only what ``edited_marks`` needs.
    """
    # Both joins read the same columns by the same keys, so they share one shuffle. The tie's last bit tells a null doc_id.
    tie = F.xxhash64("text").bitwiseAND(F.lit(-2)).bitwiseOR(F.isnull("doc_id").cast("long"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", tie)
    ids = texts.groupBy("doc_id", "tie").agg(F.first(F.char_length("text")).cast("long").alias("n_chars"))
    ring = written(next_documents(ids), "ring")

    def key(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("long")

    def narrow(df: DataFrame, marks: str) -> DataFrame:
        parts = [part.alias(f"{marks}_{n}") for n, part in enumerate(packed(F.col(marks)))]
        return df.select(*[c for c in df.columns if c != marks], *parts)

    def wide(df: DataFrame, marks: str) -> DataFrame:
        parts = [f"{marks}_{n}" for n in range(3)]
        return df.withColumn(marks, unpacked(*map(F.col, parts))).drop(*parts)

    whole = narrow(texts.select(key("doc_id").alias("key"), "tie", "text", rolled(F.col("text"), k, window).alias("marks")), "marks")
    wanted = ring.select(
        key("doc_id").alias("for_key"),
        F.col("tie").alias("for_tie"),
        "n_chars",
        F.floor(F.col("n_chars") / 3).cast("int").alias("third"),
        key("next_id").alias("key"),
        F.col("next_tie").alias("tie"),
    )
    # lengths come along as columns: filters over marks must not count characters once a mark
    replaced = F.least("third", F.char_length("text"))

    def of_head(inside: bool):
        def kept(n: Column) -> Column:
            return F.filter("marks", lambda x: (positions_of(x) <= n - (k + window - 1)) == F.lit(inside))

        return bound(replaced, kept)

    heads = (
        wide(whole.join(wanted, ["key", "tie"]), "marks")
        .select(
            F.col("for_key").alias("key"),
            F.col("for_tie").alias("tie"),
            "n_chars",
            (F.col("n_chars") - F.col("third")).cast("int").alias("cut"),
            replaced.alias("head_chars"),
            F.substring("text", F.lit(1), F.col("third")).alias("head"),
            of_head(True).alias("head_marks"),
            hashes(of_head(False)).alias("other_hashes"),
        )
    )
    heads = narrow(heads, "head_marks").dropDuplicates(["key", "tie"])
    joined = wide(wide(whole.join(heads, ["key", "tie"]), "marks"), "head_marks").withColumn("edited_text", F.concat(F.substring("text", F.lit(1), F.col("cut")), "head"))
    parts = [F.col(c) for c in ("marks", "head_marks", "edited_text", "cut", "head_chars")]
    edited = joined.select(
        F.when(F.col("tie").bitwiseAND(F.lit(1)) == 0, F.col("key")).cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "text",
        "n_chars",
        "edited_text",
        "marks",
        edited_marks(*parts, k, window).alias("edited_marks"),
        F.array_union(hashes(F.col("head_marks")), F.col("other_hashes")).alias("next_hashes"),
    )
    own = hashes(F.col("marks"))
    return edited.select(
        "doc_id",
        "text",
        "n_chars",
        "edited_text",
        "marks",
        "edited_marks",
        bound(own, lambda h: likeness(h, hashes(F.col("edited_marks")))).alias("near_edited"),
        bound(own, lambda h: likeness(h, F.col("next_hashes"))).alias("near_next"),
    )


def digest(marks: Column) -> Column:
    """One string for a fingerprint: sha256 over its hashes and positions in order."""
    return F.sha2(F.array_join(F.transform(marks, lambda x: x.cast("string")), ",").cast("binary"), 256)
