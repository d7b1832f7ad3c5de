"""Spelling correction as a job over distinct words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.functions import text as tx
from postsift.operators import tokenmap
from postsift.sources.tables import cut_lineage

# Unknown words of one form that one task compares with the known words of that form, and known words for segments.
WORDS_PER_SALT = 1024
# A word is cut into one part more than there may be edits, so that one part is left as it is.
PARTS = 3
# Letters, and pairs of them, are dealt into so many bits.
MASK_BITS = 61


def _drop_one(w: Column) -> Column:
    """The word itself and every word with one character less."""
    shorter = F.transform(
        F.sequence(F.lit(1), F.length(w)),
        lambda i: F.concat(F.substring(w, 1, i - 1), F.substring(w, i + 1, F.length(w))),
    )
    return F.array_distinct(F.concat(F.array(w), shorter))


def _drop_two(w: Column) -> Column:
    """The word itself and every word with one or two characters less."""
    n = F.length(w)
    both = F.transform(
        F.sequence(F.lit(1), n - 1),
        lambda i: F.transform(
            F.sequence(i + 1, n),
            lambda j: F.concat(
                F.substring(w, 1, i - 1), F.substring(w, i + 1, j - i - 1), F.substring(w, j + 1, n)
            ),
        ),
    )
    return F.when(n >= 2, F.array_distinct(F.concat(_drop_one(w), F.flatten(both)))).otherwise(_drop_one(w))


def _swapped_neighbours(a: Column, b: Column) -> Column:
    return (F.length(a) == F.length(b)) & F.exists(
        F.sequence(F.lit(1), F.length(a) - 1),
        lambda i: F.concat(
            F.substring(a, 1, i - 1),
            F.substring(a, i + 1, F.lit(1)),
            F.substring(a, i, F.lit(1)),
            F.substring(a, i + 2, F.length(a)),
        )
        == b,
    )


def checkable(token: Column) -> Column:
    """Words that are looked at: letters only, longer than two, not all capitals."""
    capitals = (token == F.upper(token)) & (token != F.lower(token))
    return token.rlike(r"^\p{L}{3,}$") & ~capitals


def known_words(vocab: DataFrame, min_count: int = 5) -> DataFrame:
    """Words seen often enough to serve as the dictionary: ``(lang, word, n)``, lower case."""
    return (
        vocab.where(F.col("token").rlike(r"^\p{L}{2,}$"))
        .groupBy("lang", F.lower("token").alias("word"))
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= min_count)
    )


def _best(unknown: DataFrame, known: DataFrame, keys, close: Column, distance: int) -> DataFrame:
    """Closest known word per unknown one: most frequent first, then alphabetical.

    Pairs meet on a shared shortened form. A form that many words share is cut into parts of about
    ``WORDS_PER_SALT`` unknown words, and its known words go to each part; forms without a known word, or
    without an unknown one, are dropped before.
    """
    left = cut_lineage(tx.explode_rows(unknown, "lang", "word", form=keys(F.col("word"))))
    right = cut_lineage(tx.explode_rows(known, "lang", F.col("word").alias("correction"), "n", form=keys(F.col("word"))))
    salts = left.groupBy("lang", "form").agg(F.ceil(F.count("*") / WORDS_PER_SALT).cast("int").alias("salts"))
    many = cut_lineage(salts.where("salts > 1"))
    left = left.join(many, ["lang", "form"], "left").withColumn(
        "salt", F.pmod(F.xxhash64("word"), F.coalesce("salts", F.lit(1))).cast("int")
    )
    right = right.join(many, ["lang", "form"], "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    )
    left, right = left.drop("salts"), right.drop("salts")
    pairs = left.join(right, ["lang", "form", "salt"]).where(close)
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("correction"))).alias("b")
    return (
        pairs.groupBy("lang", "word")
        .agg(best)
        .select("lang", "word", F.col("b.correction").alias("correction"), F.lit(distance).alias("distance"))
    )


def _marks(w: Column) -> Column:
    """``struct(one, two)``: a bit for each letter of the word, and for each pair of neighbours with its two ends. An edit changes at most two
    letters and four pairs, and so no more bits than that."""
    padded = F.concat(F.array(F.lit(0)), F.transform(F.split(w, ""), F.ascii), F.array(F.lit(0)))
    follow = F.zip_with(padded, F.slice(padded, F.lit(2), F.size(padded)), lambda a, b: F.coalesce(97 * a + b, F.lit(0)))

    def bits(values: Column) -> Column:
        one = F.transform(values, lambda v: F.call_function("shiftleft", F.lit(1).cast("long"), v % MASK_BITS))
        return F.aggregate(one, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))

    return F.struct(bits(padded).alias("one"), bits(follow).alias("two"))


def _alike(a: str, b: str, distance: int) -> Column:
    """Words whose marks differ by no more than that many edits change."""
    near = lambda c, most: F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) <= most * distance
    return near("one", 2) & near("two", 4)


def _part(n: Column, i: int) -> tuple[Column, Column]:
    """Begin (from 1) and length of part ``i`` of a word of ``n`` letters; parts differ by one letter at most, the last are the longer ones."""
    short = F.floor(n / PARTS).cast("int")
    longer = n - short * PARTS
    length = short + F.when(F.lit(i) >= PARTS - longer, 1).otherwise(0)
    begin = 1 + short * i + F.greatest(F.lit(0), longer - (PARTS - i))
    return begin.cast("int"), length.cast("int")


def _own_parts(w: Column) -> Column:
    """The parts of a known word: its length, the part's number and letters."""
    n = F.length(w)
    return F.array(*[F.struct(n.alias("size"), F.lit(i).alias("part"), F.substring(w, *_part(n, i)).alias("letters")) for i in range(PARTS)])


def _met_parts(w: Column, distance: int) -> Column:
    """All parts that a known word within the distance can share with ``w``, for each length that it can have.

    With ``d`` letters more in ``w`` than in the known word, part ``i`` begins in ``w`` at most ``i`` places from its own place, as otherwise
    more than ``i`` edits lie before it and another part is the one left as it is, and likewise at most
    ``distance - i`` places from its place counted from the end.
    """
    out = []
    for d in range(-distance, distance + 1):
        n = F.length(w) - d
        for i in range(PARTS):
            begin, length = _part(n, i)
            for move in range(max(-i, d - (distance - i)), min(i, d + (distance - i)) + 1):
                at = begin + move
                fits = (n >= PARTS) & (at >= 1) & (at + length - 1 <= F.length(w))
                out.append(F.when(fits, F.struct(n.alias("size"), F.lit(i).alias("part"), F.substring(w, at, length).alias("letters"))))
    return F.filter(F.array(*out), lambda p: p.isNotNull())


def _best_by_parts(unknown: DataFrame, known: DataFrame, distance: int = PARTS - 1) -> DataFrame:
    """Closest known word within the distance per unknown one, as `_best`.

    A known word is cut into ``PARTS`` parts. After ``distance`` edits one of them is still there, near its place, so pairs meet on a part, its number
    and the known word's length: three rows for a known word, at most 19 for an unknown one. Pairs whose letters
    and pairs of letters differ too much go before their distance is measured. Where many words share a part, both sides are cut into blocks. A known word
    with fewer letters than parts, which a longer word can only be close to with one of its letters in common, meets it on that letter.
    """
    left = tx.explode_rows(unknown.withColumn("marks", _marks(F.col("word"))), "lang", "word", "marks", p=_met_parts(F.col("word"), distance))
    left = cut_lineage(left.select("lang", "word", "marks", "p.*"))
    long_ = known.where(F.length("word") >= PARTS).withColumn("known_marks", _marks(F.col("word")))
    right = tx.explode_rows(long_, "lang", F.col("word").alias("correction"), "n", "known_marks", p=_own_parts(F.col("word")))
    right = cut_lineage(right.select("lang", "correction", "n", "known_marks", "p.*"))
    key = ["lang", "size", "part", "letters"]
    blocks = [side.groupBy(*key).agg(F.ceil(F.count("*") / WORDS_PER_SALT).cast("int").alias(name)) for side, name in ((left, "u"), (right, "k"))]
    many = cut_lineage(blocks[0].join(blocks[1], key).where("u > 1 or k > 1"))

    def dealt(side: DataFrame, word: str, own: str, other: str) -> DataFrame:
        """Each row in its own block, once for every block of the other side."""
        side = side.join(many, key, "left")
        mine = F.pmod(F.xxhash64(word), F.coalesce(own, F.lit(1))).cast("int")
        return side.withColumn(f"b{own}", mine).withColumn(f"b{other}", F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))).drop("u", "k")

    met = dealt(left, "word", "u", "k").join(dealt(right, "correction", "k", "u"), [*key, "bu", "bk"])
    pairs = met.where(_alike("marks", "known_marks", distance)).where(F.levenshtein("word", "correction", distance) >= 0).select("lang", "word", "correction", "n")
    each = F.array_distinct(F.split("word", ""))
    short = tx.explode_rows(known.where(F.length("word") < PARTS), "lang", F.col("word").alias("correction"), "n", letter=each)
    small = tx.explode_rows(unknown.where(F.length("word") < PARTS + distance), "lang", "word", letter=each).join(short, ["lang", "letter"])
    small = small.where(F.levenshtein("word", "correction", distance) >= 0)
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("correction"))).alias("b")
    found = pairs.unionByName(small.select("lang", "word", "correction", "n")).groupBy("lang", "word").agg(best)
    return found.select("lang", "word", F.col("b.correction").alias("correction"), F.lit(distance).alias("distance"))


def _within_reach(unknown: DataFrame, known: DataFrame, distance: int) -> DataFrame:
    """Without words that are longer than every known word of the language by more than the distance: they
    have no correction, and a very long one has very many forms."""
    longest = known.groupBy("lang").agg(F.max(F.length("word")).alias("longest"))
    return unknown.join(longest, "lang").where(F.length("word") <= F.col("longest") + distance).drop("longest")


def corrections(vocab: DataFrame, known: DataFrame, max_distance: int = 2, by_parts: bool = False) -> DataFrame:
    """``(lang, word, correction, distance)`` for unknown words that have a known word close by.

    Distance one (insert, delete, replace, swap) is tried first; only words without a hit go on to
    distance two (Levenshtein). ``by_parts`` finds these by parts instead of shortened forms, with the same result: it shuffles a quarter of the
    rows, but compares many more pairs where words are made of the same parts.
    """
    unknown = (
        vocab.where(checkable(F.col("token")))
        .select("lang", F.lower("token").alias("word"))
        .distinct()
        .join(known.select("lang", "word"), ["lang", "word"], "left_anti")
    )
    known = cut_lineage(known)
    unknown = cut_lineage(_within_reach(unknown, known, max_distance))
    a, b = F.col("word"), F.col("correction")
    near = (F.levenshtein(a, b, 1) >= 0) | _swapped_neighbours(a, b)
    first = cut_lineage(_best(unknown, known, _drop_one, near, 1))
    if max_distance < 2:
        return first
    rest = unknown.join(first.select("lang", "word"), ["lang", "word"], "left_anti")
    if by_parts:
        return first.unionByName(_best_by_parts(rest, known))
    return first.unionByName(_best(rest, known, _drop_two, F.levenshtein(a, b, 2) >= 0, 2))


def as_token_map(vocab: DataFrame, fixes: DataFrame) -> DataFrame:
    """Corrections for the words as written: a capital first letter is kept."""
    c = F.col("correction")
    first = F.substring("token", 1, 1)
    capital = (first == F.upper(first)) & (first != F.lower(first))
    kept = F.when(capital, F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, F.lit(2), F.length(c)))).otherwise(c)
    return (
        vocab.where(checkable(F.col("token")))
        .withColumn("word", F.lower("token"))
        .join(fixes, ["lang", "word"])
        .select("lang", "token", kept.alias("value"))
    )


def correct_spelling(
    df: DataFrame, key: str, text: str, lang: str, out: str, dictionary: DataFrame | None = None, min_count: int = 5, max_distance: int = 2
) -> DataFrame:
    """Correct the words of a text column against ``dictionary (lang, word, n)`` or the corpus itself."""
    vocab = tokenmap.vocabulary(df, text, lang)
    known = known_words(vocab, min_count) if dictionary is None else dictionary
    fixes = corrections(vocab, known, max_distance)
    return tokenmap.apply_token_map(df, as_token_map(vocab, fixes), key, text, lang, out)
