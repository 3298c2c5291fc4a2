"""Best contact per registrant: an exact top-1 similarity join without a cross join.

A pair of names scores well for one of a few reasons, and each reason has its
own equi-join:

==========  =========================================  ==========================
reason      what the names share                       how they meet
==========  =========================================  ==========================
equal       everything (100)                           hash join on the name
covered     one's tokens, or nearly, inside the other  two rarest tokens
inside      the shorter stands inside the longer       substrings
similar     most characters, in some order of tokens   two of the rarest grams
window      the shorter is like part of the longer     rarest gram (below 90)
==========  =========================================  ==========================

The first three give a score by themselves. They run first, and the best of
them bounds what is worth scoring: of the pairs that the other two bring, those
whose upper bound is below it are dropped before they reach Python.

The score is the best over the reasons, so the best contact is the best over
their best contacts; equal scores go to the first contact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..store import settled
from . import grams as G
from . import keys as K
from . import scan
from .index import ContactIndex, Fresh, contacts_of
from .normalize import CONTACT_POS

# Score of a pair whose shorter name stands inside a much longer one.
INSIDE_SCORE = 100.0 * S.PARTIAL_WEIGHT
# Lowest cutoff at which a window that is not the whole shorter name does not matter.
FULL_REASONS_FROM = INSIDE_SCORE
_ANY_LENGTH = 2**31 - 1
_SCORED = ("name", "score", CONTACT_POS)


def _best(scored: DataFrame) -> DataFrame:
    """Highest score per name, first contact among equals (partial aggregation, no sort)."""
    top = F.max(F.struct("score", (-F.col(CONTACT_POS)).alias("_order")))
    return scored.groupBy("name").agg(top.alias("_top")).select(
        "name", F.col("_top.score").alias("score"), (-F.col("_top._order")).alias(CONTACT_POS)
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _spread(left: str = "size", right: str = "contact_size") -> Column:
    return F.greatest(left, right) / F.least(left, right)


def _near() -> Column:
    return _spread() < S.PARTIAL_FROM


def _dealt(names: DataFrame) -> DataFrame:
    """Names dealt evenly over all shuffle partitions.

    Keys are many times larger than names; a fixed partition count keeps
    adaptive execution from packing the names into few tasks before that.
    By a hash of the name, for an exchange by the name itself would be dropped
    as already there.  All branches share the exchange.
    """
    parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return names.repartition(parts, F.xxhash64("name"))


class _Sides:
    """Both sides' distinct names, with tokens, for one cutoff."""

    def __init__(self, wanted: DataFrame, contacts: DataFrame, cutoff: float, kept: Fresh):
        self.wanted = settled(K.with_tokens(_dealt(wanted)))
        self.contacts = kept.table("tokens", ["name"], lambda: K.with_tokens(_dealt(contacts)), settle=True)
        self.kept = kept
        self.cutoff = cutoff
        self.share = cutoff / 100

    def candidates(self, wanted: DataFrame, contacts: DataFrame, by: list[str]) -> DataFrame:
        """Pairs of rows with equal keys; contact columns get ``contact_`` names."""
        renamed = contacts.select(*by, F.col("name").alias("contact_name"), CONTACT_POS)
        return wanted.join(renamed, by)

    def decided(self, found: list[DataFrame], pairs: list[DataFrame]) -> DataFrame:
        """Best contact per name of those ``found`` with a score and of the ``pairs`` to be scored."""
        known = settled(_best(_union(found))) if found else None
        scored = worth_scoring(_union(pairs), known).withColumn("score", S.weighted_ratio("name", "contact_name"))
        scored = scored.where(F.col("score") >= self.cutoff).select(*_SCORED)
        return _best(scored if known is None else scored.unionByName(known.select(*_SCORED)))


def worth_scoring(pairs: DataFrame, known: DataFrame | None) -> DataFrame:
    """Distinct pairs whose upper bound ``most`` reaches the score that their name has already."""
    distinct = pairs.groupBy("name", "contact_name", CONTACT_POS).agg(F.max("most").alias("most"))
    if known is None:
        return distinct
    reached = known.select("name", F.col("score").alias("_reached"))
    return distinct.join(reached, "name", "left").where(
        F.col("_reached").isNull() | (F.col("most") >= F.col("_reached") - K.SLACK)).drop("_reached")


def _covered(sides: _Sides) -> DataFrame:
    """One side's tokens, or all but very short ones, all present on the other side."""
    found = G.covered_pairs(sides.wanted, sides.contacts, sides.cutoff / S.TOKEN_WEIGHT, sides.kept)
    scored = found.withColumn("score", S.TOKEN_WEIGHT * F.col("own"))
    return scored.where(_near() & (F.col("score") >= sides.cutoff)).select(*_SCORED)


def _inside(sides: _Sides) -> DataFrame:
    """The shorter name is part of the longer one, 1.5 to 8 times as long."""
    size = F.col("size")
    low = F.ceil(size / S.FAR_FROM - K.SLACK).cast("int")
    high = F.floor(size / S.PARTIAL_FROM + K.SLACK).cast("int")
    listed = size <= K.SUBSTRING_LENGTH
    wanted = sides.wanted.select("name", "size")
    contacts = sides.contacts.select("name", "size", CONTACT_POS)

    # A name listed inside a longer one is short, which bounds what is sent.
    short = size <= K.SUBSTRING_LENGTH
    whole_contacts = sides.kept.table("whole", ["key"], lambda: contacts.where(short).select(
        F.col("name").alias("key"), F.col("size").alias("contact_size"), CONTACT_POS
    ))
    parts = K.substrings(wanted.where(listed), low, high, K.SUBSTRING_LENGTH)
    in_wanted = K.lookup(parts.distinct(), whole_contacts, "key", F.col("name"))
    whole_wanted = wanted.where(short).withColumn("key", F.col("name"))
    parts = K.substrings(contacts.where(listed), low, high, K.SUBSTRING_LENGTH).select(
        "key", F.col("size").alias("contact_size"), CONTACT_POS
    )
    # However many contacts hold a part, one of each length is enough.
    first = sides.kept.table("parts", ["key"], lambda: parts.groupBy("key", "contact_size").agg(
        F.min(CONTACT_POS).alias(CONTACT_POS)))
    in_contact = whole_wanted.join(first, "key")

    # Longer names: meet on the first characters of the shorter one.
    head = K.SUBSTRING_LENGTH // int(S.FAR_FROM)

    def heads(names: DataFrame) -> DataFrame:
        return names.where(size >= head).withColumn("key", F.substring("name", 1, head))

    def windows(names: DataFrame) -> DataFrame:
        return K.substrings(names.where(~listed), F.lit(head), F.lit(head), _ANY_LENGTH).distinct()

    def renamed(names: DataFrame) -> DataFrame:
        return names.select(
            "key", F.col("name").alias("contact_name"), F.col("size").alias("contact_size"), CONTACT_POS
        )

    long_wanted = windows(wanted).join(sides.kept.table("heads", ["key"], lambda: renamed(heads(contacts))), "key").where(
        F.contains("name", "contact_name")
    )
    long_contact = heads(wanted).join(sides.kept.table("windows", ["key"], lambda: renamed(windows(contacts))), "key").where(
        F.contains("contact_name", "name")
    )
    columns = ["name", "size", "contact_size", CONTACT_POS]
    found = _union([f.select(*columns) for f in (in_wanted, in_contact, long_wanted, long_contact)])
    fits = (_spread() >= S.PARTIAL_FROM) & (_spread() <= S.FAR_FROM)
    return found.where(fits).withColumn("score", F.lit(INSIDE_SCORE)).select(*_SCORED)


def _strict_matches(wanted: DataFrame, contacts: DataFrame, cutoff: float, kept: Fresh) -> DataFrame:
    """Best matches at a cutoff of at least 90."""
    sides = _Sides(wanted, contacts, cutoff, kept)
    found = []
    if cutoff <= 100 * S.TOKEN_WEIGHT:
        found.append(_covered(sides))
    if cutoff <= INSIDE_SCORE:
        found.append(_inside(sides))
    if scan.few_enough(sides.wanted, sides.contacts):
        similar = scan.scanned_pairs(sides.wanted, sides.contacts, sides.share, kept=kept)
    else:
        similar = G.similar_pairs(sides.wanted, sides.contacts, sides.share, kept)
    return sides.decided(found, [similar])


# --- cutoffs below 90 ------------------------------------------------------------------


def _shared_token(sides: _Sides) -> DataFrame:
    """A token in common and lengths apart: one fixed score, so one contact per token and length."""
    wanted = sides.wanted.select("name", "size", F.explode("kinds").alias("key"))
    table = sides.contacts.select(F.explode("kinds").alias("key"), F.col("size").alias("contact_size"), CONTACT_POS)
    table = table.groupBy("key", "contact_size").agg(F.min(CONTACT_POS).alias(CONTACT_POS))
    found = K.lookup(wanted, table, "key", F.col("name")).where(_spread() >= S.PARTIAL_FROM)
    weight = F.when(_spread() <= S.FAR_FROM, S.TOKEN_WEIGHT * S.PARTIAL_WEIGHT).otherwise(
        S.TOKEN_WEIGHT * S.FAR_PARTIAL_WEIGHT
    )
    return found.withColumn("score", 100.0 * weight).where(F.col("score") >= sides.cutoff).select(*_SCORED)


def _shared_character_pairs(sides: _Sides) -> DataFrame:
    """Any positive score needs a character in common (or two texts without tokens)."""
    def characters(names: DataFrame) -> DataFrame:
        kept = F.array_distinct(F.split("name", ""))
        kept = F.when(F.size("kinds") == 0, F.array_append(kept, F.lit("blank"))).otherwise(kept)
        return names.withColumn("key", F.explode(F.filter(kept, lambda ch: ch != ""))).drop("words", "kinds", "flat")

    pairs = sides.candidates(characters(sides.wanted), characters(sides.contacts), ["key"])
    return pairs.withColumn("most", F.lit(100.0))


def _loose_matches(wanted: DataFrame, contacts: DataFrame, cutoff: float, kept: Fresh) -> DataFrame:
    """Best matches below 90, for the names that found nothing better."""
    sides = _Sides(wanted, contacts, cutoff, kept)
    if sides.share <= G.LOWEST_SHARE:
        return sides.decided([], [_shared_character_pairs(sides)])
    found = [_covered(sides), _shared_token(sides)]
    window = min(sides.share / S.PARTIAL_WEIGHT, 1.0)
    if scan.few_enough(sides.wanted, sides.contacts):
        return sides.decided(found, [scan.scanned_pairs(sides.wanted, sides.contacts, sides.share, window, kept)])
    spread = _spread()
    far = (spread >= S.PARTIAL_FROM) & (spread <= S.FAR_FROM)
    windows = G.window_pairs(sides.wanted, sides.contacts, window, far, S.PARTIAL_WEIGHT)
    similar = G.similar_pairs(sides.wanted, sides.contacts, sides.share, kept)
    return sides.decided(found, [similar, windows])


# --- operator --------------------------------------------------------------------------


def best_contacts(registrants: DataFrame, contacts: DataFrame | ContactIndex, score_cutoff: float = 90.0) -> DataFrame:
    """Best contact per distinct registrant name: ``name, score, contact_pos, matched``.

    ``contacts`` needs ``Name`` and ``contact_pos``.  Names without a match are absent.
    """
    cutoff = float(score_cutoff)
    contacts, kept = contacts_of(contacts)
    filled = F.col("Name").isNotNull() & (F.col("Name") != "")
    wanted = registrants.where(filled).select(F.col("Name").alias("name")).distinct()

    def distinct_contacts() -> DataFrame:
        return contacts.where(filled).groupBy(F.col("Name").alias("name")).agg(F.min(CONTACT_POS).alias(CONTACT_POS))

    known = kept.table("known", ["name"], distinct_contacts, settle=cutoff < 100)
    score = F.lit(100.0).alias("score")
    if cutoff >= 100:
        equal = wanted.join(known, "name").select("name", score, CONTACT_POS, F.col("name").alias("matched"))
        return equal if cutoff == 100 else equal.where(F.lit(False))
    first = settled(wanted.join(known, "name", "left"))
    equal = first.where(F.col(CONTACT_POS).isNotNull()).select("name", score, CONTACT_POS, F.col("name").alias("matched"))
    rest = first.where(F.col(CONTACT_POS).isNull()).select("name")
    strict = _strict_matches(rest, known, max(cutoff, FULL_REASONS_FROM), kept)
    # The name comes from the same settled table as the position.
    named = kept.table("named", [CONTACT_POS], lambda: known.select(CONTACT_POS, F.col("name").alias("matched")))
    if cutoff >= FULL_REASONS_FROM:
        return equal.unionByName(strict.join(named, CONTACT_POS))
    strict = settled(strict)
    rest = settled(rest.join(strict, "name", "left_anti"))
    loose = _loose_matches(rest, known, max(cutoff, K.SLACK), kept)
    return equal.unionByName(strict.unionByName(loose).join(named, CONTACT_POS))


def fuzzy_match(registrants: DataFrame, contacts: DataFrame | ContactIndex, score_cutoff: float = 90.0) -> DataFrame:
    """One row per registrant: the best contact by weighted ratio, or nulls below the cutoff.

    For many registrant lists against the same contacts give a ``ContactIndex``.

    Output: ``Name registrant, Name fuzzy matched, Score, Index``, where
    ``Index`` is the ``contact_pos`` of the first contact with that name.
    """
    best = best_contacts(registrants, contacts, score_cutoff)
    if score_cutoff <= 0:
        best = best.unionByName(_first_contact_for(registrants, contacts_of(contacts)[0], best))
    # A name may be held by many registrants: spread each over several tasks.
    salts = F.sequence(F.lit(0), F.lit(K.SALTS - 1))
    best = best.withColumn("_salt", F.explode(salts)).withColumnRenamed("name", "_name")
    rows = registrants.select("Name").withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(K.SALTS)))
    known = rows.where(F.col("Name").isNotNull()).join(
        best, (F.col("Name") == F.col("_name")) & (rows["_salt"] == best["_salt"]), "left"
    )
    found = known.select(
        F.col("Name").alias("Name registrant"),
        F.col("matched").alias("Name fuzzy matched"),
        F.col("score").alias("Score"),
        F.col(CONTACT_POS).alias("Index"),
    )
    nameless = registrants.where(F.col("Name").isNull()).select(
        F.col("Name").alias("Name registrant"),
        F.lit(None).cast("string").alias("Name fuzzy matched"),
        F.lit(None).cast("double").alias("Score"),
        F.lit(None).cast("bigint").alias("Index"),
    )
    return found.unionByName(nameless)


def _first_contact_for(registrants: DataFrame, contacts: DataFrame, best: DataFrame) -> DataFrame:
    """At a cutoff of 0 a name without any similarity still gets the first contact."""
    left = registrants.where(F.col("Name").isNotNull()).select(F.col("Name").alias("name")).distinct()
    left = left.join(best, "name", "left_anti").withColumn("_one", F.lit(1))
    first = contacts.where(F.col("Name").isNotNull()).agg(
        F.min(F.struct(CONTACT_POS, F.col("Name").alias("matched"))).alias("_first")
    ).where(F.col("_first").isNotNull()).select("_first.*", F.lit(1).alias("_one"))
    return left.join(F.broadcast(first), "_one").select(
        CONTACT_POS, "name", F.lit(0.0).alias("score"), "matched"
    )
