"""Which pairs of names can reach a token-set score: an index of words and letter counts.

A score of `threshold` or more has one of three reasons, and each leaves a trace that two names can be joined on.

* All words of one name occur in the other, or the shared words make up enough of one name. Then of the longest words of that name, taken until
  they outweigh what may be left unshared, one is shared. Those words meet all words of the other name.
* The letters agree in order. Then the letter counts differ by few in all. The letters are dealt into so many groups, by the length of the
  ranked name, that in one group the counts differ by one at most. The ranked names carry the counts of each group; the listed names carry
  them with every change by one, for all lengths that allow the score.

Both kinds of trace are one hash, so the index is one equi-join. What meets is held against the exact bounds on words and letter counts; only
survivors are worth comparing letter by letter. No pair that reaches the threshold is lost; names whose length asks for more groups than there
are letters (about 200 letters at 85) meet all names of like length instead.

Null names and names without a word are in no pair. Repeated rows meet as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a cleaned name may hold, about by frequency, so that dealing letters out in turn gives groups of like weight.
LETTERS = " eationsrlhdcumfpgwybvkxjqz0123456789_"


def words_of(name: Column) -> Column:
    """The different words of a name in order: ASCII letters, digits and underscores, in lower case."""
    plain = F.regexp_replace(F.lower(name), r"[^\x00-\x7F]", "")
    return F.array_sort(F.array_distinct(F.filter(F.split(F.regexp_replace(plain, "[^a-z0-9_]", " "), " "), lambda w: w != "")))


def letter_counts(text: Column) -> Column:
    return F.transform(F.array(*[F.lit(x) for x in LETTERS]), lambda x: F.length(text) - F.length(F.replace(text, x)))


class Bounds:
    """What a score of `threshold` or more allows, for names of the given lengths (words joined by blanks)."""

    def __init__(self, threshold: int) -> None:
        if not 50 <= threshold <= 100:
            raise ValueError("the threshold must be between 50 and 100")
        self.loose = (100.5 - threshold) / 100  # a score is rounded, half a point may be missing
        self.unshared = 1 - (threshold - 0.5) / (200.5 - threshold)

    def apart(self, a: Column, b: Column) -> Column:
        """Letters by which two names may differ in all."""
        return F.floor(F.lit(self.loose) * (a + b) + 1e-9).cast("int")

    def longest(self, n: Column) -> Column:
        return F.floor(n * ((1 + self.loose) / (1 - self.loose)) + 1e-9).cast("int")

    def shortest(self, n: Column) -> Column:
        return F.ceil(n * ((1 - self.loose) / (1 + self.loose)) - 1e-9).cast("int")

    def groups(self, n: Column) -> Column:
        """Groups of letters for ranked names of this length: in one of them two names differ by one at most. 0: by length alone."""
        wanted = F.floor(self.apart(n, self.longest(n)) / 2).cast("int") + 1
        return F.when(wanted <= len(LETTERS), wanted).otherwise(0)

    def heavy_words(self, words: Column, n: Column) -> Column:
        """The longest words, until together they have more letters than may be left unshared."""
        ordered = F.array_sort(F.transform(words, lambda w: F.struct((-F.length(w)).alias("falling"), w.alias("w"))))
        before = lambda i: F.aggregate(F.slice(ordered, 1, i), F.lit(0), lambda s, x: s - x["falling"])
        return F.transform(F.filter(ordered, lambda x, i: before(i) <= F.lit(self.unshared) * n), lambda x: x["w"])


def signed(names: DataFrame, column: str, bounds: Bounds) -> DataFrame:
    """Add words, text, n (its length), letters (counts) and heavy; names without a word go."""
    given = names.withColumn("words", words_of(F.col(column))).where(F.size("words") > 0)
    given = given.withColumn("text", F.array_join("words", " ")).withColumn("n", F.length("text"))
    return given.withColumn("letters", letter_counts(F.col("text"))).withColumn("heavy", bounds.heavy_words(F.col("words"), F.col("n")))


def word_keys(meets_all: str, met_by_all: str) -> Column:
    """Listed names use 1 for their heavy words, ranked ones for all of theirs; 2 is the other way round."""
    return F.concat(
        F.transform(F.col(meets_all), lambda w: F.xxhash64(F.lit(1), w)), F.transform(F.col(met_by_all), lambda w: F.xxhash64(F.lit(2), w))
    )


def letter_key(length: Column, group: Column, groups: Column, letters: Column) -> Column:
    mine = F.filter(letters, lambda x, i: F.pmod(i, groups) == group)
    return F.xxhash64(F.lit(0), length, group, mine)


def length_key(length: Column) -> Column:
    return F.xxhash64(F.lit(3), length)


def ranked_keys(pool: DataFrame, bounds: Bounds) -> DataFrame:
    """A row of `pool` (signed) for each of its keys."""
    groups = bounds.groups(F.col("n"))
    by_letters = F.transform(F.sequence(F.lit(0), groups - 1), lambda g: letter_key(F.col("n"), g, groups, F.col("letters")))
    by_length = F.when(groups > 0, by_letters).otherwise(F.array(length_key(F.col("n"))))
    return pool.withColumn("key", F.explode(F.concat(word_keys("words", "heavy"), by_length)))


def listed_keys(truth: DataFrame, bounds: Bounds) -> DataFrame:
    """A row of `truth` (signed) for each key at which a ranked name can meet it."""
    lengths = truth.withColumn("other", F.explode(F.sequence(bounds.shortest(F.col("n")), bounds.longest(F.col("n")))))
    lengths = lengths.withColumn("groups", bounds.groups(F.col("other")))
    alone = lengths.where("groups = 0").withColumn("key", length_key(F.col("other")))
    each = lengths.where("groups > 0").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    # the counts as they are (change 0 of letter 0), and with one more or one less of each letter of the group
    inside = F.filter(F.sequence(F.lit(0), F.lit(len(LETTERS) - 1)), lambda i: F.pmod(i, F.col("groups")) == F.col("group"))
    change = lambda by: F.transform(inside, lambda i: F.struct(i.alias("at"), F.lit(by).alias("by")))
    none = F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("by")))
    each = each.withColumn("change", F.explode(F.concat(none, change(1), change(-1))))
    changed = F.transform("letters", lambda x, i: x + F.when(i == F.col("change.at"), F.col("change.by")).otherwise(0))
    by_letters = each.withColumn("key", letter_key(F.col("other"), F.col("group"), F.col("groups"), changed))
    by_words = truth.withColumn("key", F.explode(word_keys("heavy", "words")))
    columns = [*truth.columns, "key"]
    return by_words.select(columns).unionByName(by_letters.select(columns)).unionByName(alone.select(columns))


def can_match(a: dict[str, Column], b: dict[str, Column], bounds: Bounds) -> Column:
    """The exact bounds for two signed names: by words or by letter counts."""
    shared = F.array_intersect(a["words"], b["words"])
    contained = F.size(shared) == F.least(F.size(a["words"]), F.size(b["words"]))
    weight = F.length(F.array_join(shared, " "))
    enough = weight >= (1 - F.lit(bounds.unshared)) * F.least(a["n"], b["n"]) - 1e-9
    apart = F.aggregate(F.zip_with(a["letters"], b["letters"], lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    return (contained | enough) | (apart <= bounds.apart(a["n"], b["n"]))
