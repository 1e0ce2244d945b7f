"""Document fingerprints by order MinHash, in DataFrame functions only.

A text is the sequence of its words; its k-mers are numbered by occurrence, so
that each (k-mer, number) pair is one element. Every element has one hash,
which also deals it to one of ``sketches`` bins; a bin keeps its ``ell`` least
elements, puts them back in text order and hashes the tuple of their k-mers
(Marcais et al., Locality-sensitive hashing for the edit distance, 2019; one
permutation in bins instead of one permutation for each sketch, so that a
text is hashed once). A bin that holds fewer than ``ell`` elements is filled
from the next ones (``filled``): its sketch is the ``ell`` least elements counted
from the bin's start round the circle of hashes, so every tuple is of ``ell``
elements and carries their order, in short texts too. Texts with the same k-mers in
another order differ, and the share of equal tuples falls with the edit distance.

Everything about one text happens in arrays of its own row; nothing is
exploded and no shuffle is needed for a fingerprint. Arrays that Spark sorts
hold plain longs: hash bits above, position below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.tables import range_dealt

K, ELL, BIN_BITS = 3, 2, 6

_SPACE = " \t\n\x0b\x0c\r"


def _fn(name: str, *args) -> Column:
    return F.call_function(name, *[a if isinstance(a, Column) else F.lit(a) for a in args])


def with_fingerprint(df: DataFrame, text: Column, out: str, k: int = K, ell: int = ELL, bin_bits: int = BIN_BITS, filled: bool = False) -> DataFrame:
    """Add ``out``: array<bigint> of the text's components, one for each of the
    2^bin_bits bins that hold an element, in bin order. A component is the
    bin's number and 26 bits of the tuple's hash, below 2^(bin_bits + 26).
    ``filled``: one for each bin of a text that is not blank, elements that a bin
    lacks taken from the next ones; only texts of fewer than ``ell`` k-mers have
    shorter tuples.

    A text of fewer than ``k`` words is one k-mer of all its words; a NULL or
    blank text has no components. An array read inside a lambda is a column used
    more than once, so that the optimiser keeps it a column and does not
    evaluate it for each element.
    """
    base = df.columns

    def step(frame: DataFrame, name: str, value: Column) -> DataFrame:
        return frame.withColumn(name, value)

    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    now = step(df, "_t", trimmed)
    now = step(now, "_w", F.when(F.col("_t") == "", F.array().cast("array<string>")).otherwise(F.split("_t", "\\s+")))
    kmers = F.transform("_w", lambda w, i: F.xxhash64(w, *[F.get(F.col("_w"), i + d) for d in range(1, k)]))
    now = step(now, "_kh", F.slice(kmers, F.lit(1), F.greatest(F.size("_w") - (k - 1), F.least(F.size("_w"), F.lit(1)))))
    now = step(now, "_b", F.length(F.bin(F.size("_kh").cast("long"))))
    top = lambda x: _fn("shiftright", x, F.col("_b"))  # noqa: E731  the bits above a position
    mask = _fn("shiftleft", F.lit(1).cast("long"), F.col("_b")) - 1
    now = step(now, "_m", mask)
    pack = lambda x, i: _fn("shiftleft", top(x), F.col("_b")).bitwiseOR(i)
    pos = lambda x: x.bitwiseAND(F.col("_m")).cast("int")

    # Occurrence numbers: in the sorted k-mers equal ones are neighbours, in text order.
    now = step(now, "_s", F.sort_array(F.transform("_kh", lambda x, i: pack(x, i.cast("long")))))
    fresh = F.transform("_s", lambda x, i: F.when(~top(x).eqNullSafe(top(F.get(F.col("_s"), i - 1))), i).otherwise(-1))
    now = step(now, "_f", F.filter(fresh, lambda i: i >= 0))
    runs = F.transform(
        "_f", lambda a, j: F.sequence(F.lit(0), F.coalesce(F.get(F.col("_f"), j + 1), F.size("_s")) - a - 1)
    )
    # ``runs`` is an argument here, not read inside the lambda: the optimiser may move
    # it in without evaluating it again for each element.
    element = F.zip_with(
        "_s", F.flatten(runs), lambda x, nth: pack(F.xxhash64(F.get(F.col("_kh"), pos(x)), nth), x.bitwiseAND(F.col("_m")))
    )
    now = step(now, "_g", F.sort_array(element))

    # The bins are ranges of the hash; each keeps its first ``ell`` elements.
    bin_of = lambda x: F.shiftrightunsigned(x, 64 - bin_bits)
    begins = F.transform("_g", lambda x, i: F.when(~bin_of(x).eqNullSafe(bin_of(F.get(F.col("_g"), i - 1))), i).otherwise(-1))
    now = step(now, "_n", F.filter(begins, lambda i: i >= 0))

    if filled:
        # Signed bins from -half to half - 1 are in the order of ``_g``; bins up to one that
        # holds elements begin where it does, those after the last at the first element again.
        half = 1 << (bin_bits - 1)
        signed = lambda i: _fn("shiftright", F.get(F.col("_g"), i), F.lit(64 - bin_bits)).cast("int")
        upto = F.transform(
            "_n", lambda a, j: F.array_repeat(a, signed(a) - F.coalesce(signed(F.get(F.col("_n"), j - 1)), F.lit(-half - 1)))
        )
        after = F.array_repeat(F.lit(0), F.lit(half - 1) - F.coalesce(signed(F.get(F.col("_n"), F.size("_n") - 1)), F.lit(half - 1)))
        now = step(now, "_a", F.concat(F.flatten(upto), after))
        now = step(now, "_c", F.concat("_g", F.slice("_g", 1, ell)))

    def component(a: Column, i: Column) -> Column:
        if filled:
            number = ((i + half) % (1 << bin_bits)).cast("long")
            least = F.slice("_c", a + 1, F.least(_fn("shiftright", F.size("_c"), 1), F.lit(ell)))
        else:
            number = bin_of(F.get(F.col("_g"), a))
            least = F.filter(F.slice("_g", a + 1, F.lit(ell)), lambda x: bin_of(x) == number)
        in_order = F.sort_array(F.transform(least, pos))
        tuple_hash = F.xxhash64(F.transform(in_order, lambda p: F.get(F.col("_kh"), p)))
        return F.shiftleft(number, 26).bitwiseOR(F.shiftrightunsigned(tuple_hash, 38))

    now = step(now, out, F.array_sort(F.transform("_a" if filled else "_n", component)))
    return now.select(*[c for c in base if c != out], out)


def as_text(fingerprint: Column) -> Column:
    """The components as one string, 8 hex digits each."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal components among the bins that either fingerprint fills;
    1 where both are empty."""
    bins = lambda fp: F.transform(fp, lambda x: F.shiftrightunsigned(x, 26))
    either = F.size(F.array_union(bins(a), bins(b)))
    same = F.size(F.array_intersect(a, b)).cast("double")
    return F.when(either == 0, F.lit(1.0)).otherwise(same / either)


def next_keys(docs: DataFrame) -> DataFrame:
    """For every distinct (absent, id, th) of ``docs``: the key and length of the
    document it follows, in the order of descending ids (NULL last), then th;
    the first follows the last.

    Range-dealt, with one boundary row for each range.
    """
    order = [F.col("absent").asc(), F.col("id").desc(), F.col("th").desc()]
    keys = docs.groupBy("absent", "id", "th").agg(F.max("n_chars").alias("n_chars"))
    dealt = range_dealt(keys, order, "ordermh-keys")
    own = F.struct("absent", "id", "th", "n_chars")
    inside = Window.partitionBy("_part").orderBy(*order)
    placed = dealt.select("*", F.lag(own).over(inside).alias("before"), F.row_number().over(inside).alias("place"))
    lasts = placed.groupBy("_part").agg(F.max_by(own, "place").alias("last"))
    parts = Window.orderBy("_part")
    whole = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = lasts.select("_part", F.coalesce(F.lag("last").over(parts), F.last("last").over(whole)).alias("ahead"))
    linked = placed.join(ends, "_part").select("absent", "id", "th", F.coalesce("before", "ahead").alias("before"))
    return linked.select(
        "absent", "id", "th",
        F.col("before.absent").alias("to_absent"), F.col("before.id").alias("to_id"),
        F.col("before.th").alias("to_th"), F.col("before.n_chars").alias("to_n"),
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited,
    near_next) for every row of ``docs``; the fingerprints are arrays.

    The edited text is the text with its last floor(n_chars / 3) code points
    replaced by the first as many (or all) of the next document's, in the order
    of descending ids; the last document is followed by the first. NULL ids come
    last, rows of one id follow each other by the hash of their texts, and rows
    equal in id and text are one place in the order with the same result each.
    NULL texts are empty. Other columns are ignored; an empty table gives no
    rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).isNull().alias("absent"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(text).alias("th"),
        F.length(text).cast("long").alias("n_chars"),
        text.alias("text"),
    )
    links = next_keys(rows.drop("text"))
    key = ["absent", "id", "th"]
    # Both sides below read the same columns of ``own``, so that Spark computes and
    # shuffles it once (the length is counted again rather than carried).
    own = with_fingerprint(rows.drop("n_chars"), F.col("text"), "fp", filled=True).repartition(*key)
    given = own.join(links, key).select(
        F.col("to_absent").alias("absent"), F.col("to_id").alias("id"), F.col("to_th").alias("th"),
        F.substring("text", F.lit(1), (F.col("to_n") / 3).cast("int")).alias("patch"),
        F.col("fp").alias("next_fp"),
    )
    given = given.groupBy(*key).agg(F.first("patch").alias("patch"), F.first("next_fp").alias("next_fp"))
    joined = own.join(given, key).withColumn("n_chars", F.length("text").cast("long"))
    cut = (F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.col("patch"))
    both = joined.select("absent", "id", "n_chars", "fp", "next_fp", edited.alias("edited"))
    both = with_fingerprint(both, F.col("edited"), "edited_fp", filled=True)
    return both.select(
        F.when(~F.col("absent"), F.col("id")).alias("doc_id"),
        "n_chars",
        "edited",
        F.col("fp").alias("fingerprint"),
        F.col("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
