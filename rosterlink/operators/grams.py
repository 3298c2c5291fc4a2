"""A rarest-first gram index that brings similar names together without loss.

The *grams* of a text are its pairs of neighbouring characters, a blank put
before and behind it. Where single blanks part the tokens, they are the same
whatever order the tokens stand in, so one index serves the plain ratio, the
ratio of sorted tokens and that of shared tokens followed by each side's own.

Removing a character spoils two grams, inserting one spoils one. Texts of ``n``
and ``m`` characters with a ratio of at least ``share`` are ``D <= (1 - share)
* (n + m)`` edits apart, ``d`` of them removals from the first, so at least
``n + 1 - d - D`` of its grams stand in the second (repeats numbered). With all
grams in one order, rarest first, the first ``lost + 2`` grams of both then
have two in common, where ``lost`` is the most that ``d + D`` can be. Each two
of these first grams are a key: rare, and 276 of them at most for a name. Very
short texts, which may keep one gram only, and very long ones, which would have
more such pairs, have single grams as keys, and so have texts that may meet them.

What meets is cut down by a *character bag*: a 64-bit word with a bit for the
first and for the second character of each of 32 kinds. Every edit changes one
bit, which also bounds the score of a pair from above.
"""

from __future__ import annotations

import json
from math import ceil, comb, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHITESPACE_CLASS, characters, let
from .index import Fresh

# Slack on computed bounds; the score itself always decides.
SLACK = 1e-9
# Kinds of grams, characters or tokens that are told apart when ordered: a table of fixed size.
KINDS = 4096
# Most first grams of which each two are a key (276 keys).
MOST_PAIRED = 24
# Most keys of a text among those that name the lengths of both texts.
MOST_KEYS = 276
# Lowest share for which similar texts are sure to have a gram in common.
LOWEST_SHARE = 2 / 3

_BAG_KINDS = 32


def _floor(value: Column) -> Column:
    return F.floor(value + F.lit(SLACK)).cast("int")


def _kind(part: Column) -> Column:
    return F.pmod(F.xxhash64(part), F.lit(KINDS)).cast("int")


# --- order ------------------------------------------------------------------------------


class Order:
    """An order of grams, characters or tokens, by how often their kind stands in ``parts``."""

    def __init__(self, parts: DataFrame):
        """``parts`` has one array column; the driver gets ``KINDS`` counts at most."""
        exploded = parts.select(F.explode(parts.columns[0]).alias("part"))
        counted = exploded.groupBy(_kind(F.col("part")).alias("kind")).count().collect()
        counts = {row["kind"]: row["count"] for row in counted}
        ranked = sorted(range(KINDS), key=lambda kind: (counts.get(kind, 0), kind))
        ranks = [""] * KINDS
        for rank, kind in enumerate(ranked):
            ranks[kind] = f"{rank:04x}"
        self._ranks = ",".join(ranks)

    def ranked(self, part: Column) -> Column:
        """``part`` with its rank before it, so that texts sort rarest first."""
        return F.concat(F.element_at(F.split(F.lit(self._ranks), ","), _kind(part) + 1), part)

    def numbered(self, parts: Column) -> Column:
        """``parts`` rarest first, the repeats of each numbered."""
        return let(F.sort_array(parts), lambda alike: F.sort_array(F.transform(alike, lambda p, i: F.concat(
            self.ranked(p), F.lit("#"), (i + 1 - F.array_position(alike, p)).cast("string")))))


def each_two(parts: Column) -> Column:
    """A key for every two of ``parts``."""
    return let(parts, lambda ps: F.flatten(F.transform(ps, lambda p, i: F.transform(
        F.slice(ps, i + 2, F.size(ps)), lambda q: F.xxhash64(p, q)))))


def neighbours(text: Column, count: Column) -> Column:
    """The first ``count`` pairs of neighbouring characters."""
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda i: F.substring(text, i, F.lit(2)))).otherwise(
        F.array().cast("array<string>"))


def padded_grams(text: Column) -> Column:
    return neighbours(F.concat(F.lit(" "), text, F.lit(" ")), F.char_length(text) + 1)


def inner_grams(text: Column) -> Column:
    return neighbours(text, F.char_length(text) - 1)


def bag(text: Column) -> Column:
    """The character bag: bits for the first and the second character of each kind."""
    kinds = F.sort_array(F.transform(characters(text), lambda ch: F.pmod(F.xxhash64(ch), F.lit(_BAG_KINDS)).cast("int")))
    # A kind's first character has bit 2k, all later ones 2k + 1.
    bits = let(kinds, lambda ks: F.transform(ks, lambda k, i: 2 * k + F.least(i + 1 - F.array_position(ks, k).cast("int"), F.lit(1))))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda word, b: word.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b)))


def missing(left: Column, right: Column) -> Column:
    """Bits of one bag that the other lacks: removals that any alignment needs."""
    return F.bit_count(left.bitwiseAND(F.bitwise_not(right)))


# --- similar texts ------------------------------------------------------------------------


def _most_lost(share: float) -> float:
    """Most grams, per character, that a text and a partner at ``share`` fail to share."""
    return 4 * (1 - share) / (2 - share)


def paired_lengths(share: float) -> tuple[int, int]:
    """Least and greatest length of a text that keeps two grams for sure and has few enough first grams."""
    lost = lambda n: floor(n * _most_lost(share) + SLACK)
    long = next((n - 1 for n in range(1, 1 << 16) if lost(n) + 2 > MOST_PAIRED), 1 << 16)
    short = next((n for n in range(long + 1) if n + 1 - lost(n) >= 2), long + 1)
    return short, long


def item_texts() -> Column:
    """The texts under which a name is compared: sorted tokens and, where they have other grams, the name as it stands and the distinct tokens."""
    words = F.array_join("words", " ")
    # The name's own grams are those of its sorted tokens if single blanks part them.
    regular = F.regexp_replace("name", WHITESPACE_CLASS + "+", " ") == F.col("name")
    regular = regular & ~F.startswith(F.col("name"), F.lit(" ")) & ~F.endswith(F.col("name"), F.lit(" "))
    return F.array_distinct(F.array(words, F.when(regular, words).otherwise(F.col("name")), F.col("flat")))


def items(names: DataFrame) -> DataFrame:
    """Adds each ``item`` of ``item_texts`` and its length ``n``."""
    return names.withColumn("item", F.explode(item_texts())).withColumn("n", F.char_length("item"))


def gram_bits(grams: Column) -> Column:
    """Two words with a bit for each of 128 kinds of ``grams``: a set that does not depend on their order."""
    def word(low: int) -> Column:
        return F.aggregate(grams, F.lit(0).cast("bigint"), lambda word, g: let(
            F.pmod(F.xxhash64(F.lit("bit"), g), F.lit(128)).cast("int") - low, lambda b: F.when(
                (b >= 0) & (b < 64), word.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b))).otherwise(word)))

    return F.array(word(0), word(64))


def _missing_grams(left: str, right: str) -> Column:
    """Kinds of grams of one text that the other lacks."""
    return missing(F.col(left)[0], F.col(right)[0]) + missing(F.col(left)[1], F.col(right)[1])


def edits_of(share: float, n: int, m: int) -> int:
    """Most edits between texts of ``n`` and ``m`` characters at ``share``; they have the parity of ``n - m``."""
    most = floor((1 - share) * (n + m) + SLACK)
    return most - (most - n + m) % 2


def _first_of(share: float, n: int, m: int) -> tuple[int, int]:
    """How many first grams of a text of ``n`` characters meet those of ``m``, and how many they have in common."""
    edits = edits_of(share, n, m)
    if edits < abs(n - m):
        return 0, 0
    lost = edits + (edits + n - m) // 2
    common = min(2, n + 1 - lost)
    return lost + common, common


def _partner_lengths(share: float, n: int) -> range:
    return range(ceil(n * share / (2 - share) - SLACK), floor(n * (2 - share) / share + SLACK) + 1)


def told_lengths(share: float) -> int:
    """Greatest length up to which keys name the lengths of both texts, so that a text has ``MOST_KEYS`` keys at most."""
    short, long = paired_lengths(share)

    def untold(n: int) -> int:
        lost, partners = floor(n * _most_lost(share) + SLACK), _partner_lengths(share, n)
        own = short <= n <= long
        alone = own and short <= partners[0] and partners[-1] <= long
        return (0 if alone else lost + 1) + (comb(lost + 2, 2) if own else 0)

    def keys(n: int, told: int) -> int:
        partners = _partner_lengths(share, n)
        firsts = [_first_of(share, n, m) for m in partners if m <= told]
        return sum(comb(*f) for f in firsts if f[1]) + (untold(n) if partners[-1] > told else 0)

    told = 0
    while all(keys(n, told + 1) <= MOST_KEYS for n in range(told + 2)):
        told += 1
    return told


def similar_keys(names: DataFrame, share: float, order: Order, mirrored: bool = False) -> DataFrame:
    """One row per key of each name: adds ``key``, ``n``, ``bag``, ``grams`` and what the pair's level is told by.

    Keys of level 3 name the lengths of both texts, the own one first or,
    ``mirrored``, second: known lengths leave fewer first grams. Levels 1 and 2
    are for pairs with a text too long for that.
    """
    short, long = paired_lengths(share)
    told = told_lengths(share)
    n = F.col("n")
    texts = items(names).withColumn("_grams", padded_grams(F.col("item")))
    listed = texts.withColumn("_first", F.transform(order.numbered(F.col("_grams")), lambda g: F.xxhash64(g))).withColumn(
        "bag", bag(F.col("item"))).withColumn("grams", gram_bits(F.col("_grams")))
    lost = _floor(n * _most_lost(share))
    own = (n >= short) & (n <= long)
    none = F.array().cast("array<bigint>")
    # Partners can be this short or long.
    least, most = F.ceil(n * share / (2 - share) - SLACK), F.floor(n * (2 - share) / share + SLACK)
    single = F.when(own & (least >= short) & (most <= long), none).otherwise(F.slice(F.col("_first"), F.lit(1), lost + 1))
    double = F.when(own, each_two(F.slice(F.col("_first"), F.lit(1), lost + 2))).otherwise(none)
    untold = most > told
    # For each length: the partner's, how many first grams to take, how many to join to a key.
    steps = [[(m, *_first_of(share, length, m)) for m in _partner_lengths(share, length) if m <= told] for length in range(told + 1)]
    steps = F.from_json(F.lit(json.dumps([[{"m": m, "take": t, "of": k} for m, t, k in row if k] for row in steps])),
                        "array<array<struct<m: int, take: int, of: int>>>")

    def told_keys(step: Column) -> Column:
        lengths = (step["m"], n) if mirrored else (n, step["m"])
        taken = F.slice(F.col("_first"), F.lit(1), step["take"])
        grams = F.when(step["of"] == 2, each_two(taken)).otherwise(taken)
        return F.transform(grams, lambda g: F.xxhash64(*lengths, g))

    exact = F.when(n <= told, F.flatten(F.transform(F.get(steps, n), told_keys))).otherwise(none)
    keys = F.concat(F.transform(F.when(untold, single).otherwise(none), lambda k: F.struct(F.lit(1).alias("level"), k.alias("key"))),
                    F.transform(F.when(untold, double).otherwise(none), lambda k: F.struct(F.lit(2).alias("level"), k.alias("key"))),
                    F.transform(exact, lambda k: F.struct(F.lit(3).alias("level"), k.alias("key"))))
    listed = listed.withColumn("own_level", F.when(own, 2).otherwise(1)).withColumn("_key", F.explode(keys))
    return listed.select(*[c for c in ("name", "contact_pos") if c in names.columns], "n", "bag", "grams", "own_level",
                         F.col("_key.level").alias("level"), F.col("_key.key").alias("key"))


def similar_pairs(wanted: DataFrame, contacts: DataFrame, share: float, kept: Fresh | None = None) -> DataFrame:
    """Candidates ``name, contact_name, contact_pos, most`` for a ratio of ``share``; ``most`` bounds the ratio from above."""
    kept = kept or Fresh()
    order = kept.order("grams", lambda: Order(contacts.select(padded_grams(F.array_join("words", " ")))))
    left = similar_keys(wanted, share, order)
    right = kept.table(f"similar {share}", ["level", "key"], lambda: similar_keys(contacts, share, order, mirrored=True)).withColumnsRenamed(
        {"name": "contact_name", "n": "m", "bag": "contact_bag", "grams": "contact_grams", "own_level": "contact_level"})
    # Keys are many times larger than the names from which a plan would guess their size: no side is broadcast.
    met = left.hint("merge").join(right, ["level", "key"])
    n, m = F.col("n"), F.col("m")
    edits = (1 - share) * (n + m) + SLACK
    gone, come = missing(F.col("bag"), F.col("contact_bag")), missing(F.col("contact_bag"), F.col("bag"))
    # A removal spoils two grams, an insertion one.
    spoilt, new = _missing_grams("grams", "contact_grams"), _missing_grams("contact_grams", "grams")
    level = F.least("own_level", "contact_level")
    fits = (F.col("level") == F.when(F.greatest(n, m) <= told_lengths(share), 3).otherwise(level)) & (F.abs(n - m) <= edits)
    fits = fits & (2 * gone <= edits + n - m) & (2 * come <= edits + m - n)
    fits = fits & (2 * spoilt <= 3 * edits + n - m) & (2 * new <= 3 * edits + m - n)
    # Edits needed at least: removals and insertions also have to make up for the lengths.
    least = F.greatest(2 * gone - n + m, 2 * come + n - m, (2 * spoilt - n + m) / 3, (2 * new + n - m) / 3)
    total = n + m
    most = F.when(total > 0, (F.lit(1.0) - least / total) * 100.0).otherwise(100.0)
    return met.where(fits).select("name", "contact_name", "contact_pos", most.alias("most"))


# --- windows --------------------------------------------------------------------------------


def _forms(names: DataFrame) -> DataFrame:
    texts = F.array_distinct(F.array(F.col("name"), F.array_join("words", " "), F.col("flat")))
    return names.withColumn("_forms", F.filter(texts, lambda t: t != ""))


def _needles(names: DataFrame, share: float, grams: Order, chars: Order) -> DataFrame:
    n = F.char_length("item")
    lost = _floor(n * _most_lost(share))
    removed = _floor(2 * n * (1 - share) / (2 - share))
    by_gram = F.transform(F.slice(grams.numbered(inner_grams(F.col("item"))), F.lit(1), lost + 1), lambda g: F.xxhash64(F.lit("gram"), g))
    by_char = F.transform(F.slice(chars.numbered(characters(F.col("item"))), F.lit(1), removed + 1), lambda g: F.xxhash64(F.lit("char"), g))
    listed = _forms(names).withColumn("item", F.explode("_forms"))
    # A text that may lose all its grams meets by its characters.
    listed = listed.withColumn("bag", bag(F.col("item"))).withColumn("n", n)
    return listed.withColumn("key", F.explode(F.when(n - 1 - lost >= 1, by_gram).otherwise(by_char))).drop("_forms", "item")


def _hays(names: DataFrame, grams: Order, chars: Order) -> DataFrame:
    by_gram = F.flatten(F.transform("_forms", lambda t: grams.numbered(inner_grams(t))))
    by_char = F.flatten(F.transform("_forms", lambda t: chars.numbered(characters(t))))
    keys = F.array_distinct(F.concat(F.transform(by_gram, lambda g: F.xxhash64(F.lit("gram"), g)),
                                     F.transform(by_char, lambda g: F.xxhash64(F.lit("char"), g))))
    bags = F.aggregate("_forms", F.lit(0).cast("bigint"), lambda word, t: word.bitwiseOR(bag(t)))
    return _forms(names).withColumn("bag", bags).withColumn("key", F.explode(keys)).drop("_forms")


def window_pairs(wanted: DataFrame, contacts: DataFrame, share: float, spread: Column, weight: float) -> DataFrame:
    """Candidates of which one has a window with a ratio of ``share`` to the whole other, as it stands or with tokens sorted.

    The whole text looks up its rarest grams among all grams of the other.
    ``spread`` restricts the lengths ``size`` and ``contact_size``; ``most`` is
    the bound of the ratio times ``weight``.
    """
    grams = Order(contacts.select(inner_grams(F.array_join("words", " "))))
    chars = Order(contacts.select(characters(F.col("name"))))
    own, other = ["name", "size"], ["name", "size", "contact_pos"]
    found = []
    for needles, hays in ((wanted.select(*own, "words", "flat"), contacts.select(*other, "words", "flat")),
                          (contacts.select(*other, "words", "flat"), wanted.select(*own, "words", "flat"))):
        left = _needles(needles, share, grams, chars).drop("words", "flat")
        right = _hays(hays, grams, chars).drop("words", "flat").withColumnRenamed("bag", "hay_bag")
        if "contact_pos" in needles.columns:
            left = left.withColumnsRenamed({"name": "contact_name", "size": "contact_size"})
        else:
            right = right.withColumnsRenamed({"name": "contact_name", "size": "contact_size"})
        gone, n = missing(F.col("bag"), F.col("hay_bag")), F.col("n")
        met = left.join(right, "key").where(spread & (gone <= 2 * n * (1 - share) / (2 - share) + SLACK))
        most = (F.lit(1.0) - gone / (2 * n - gone)) * (100.0 * weight)
        found.append(met.select("name", "contact_name", "contact_pos", most.alias("most")))
    return found[0].unionByName(found[1])


# --- tokens ---------------------------------------------------------------------------------

# Most tokens of a name of which each two are a key.
MOST_TOKENS = 24


def _all_tokens(names: DataFrame) -> DataFrame:
    """Keys of every token, and of every two of a name with few tokens."""
    kinds = F.col("kinds")
    few = F.size(kinds) <= MOST_TOKENS
    one = F.transform(kinds, lambda t: F.xxhash64(F.lit("one"), t))
    many = F.transform(kinds, lambda t: F.xxhash64(F.lit("many"), t))
    return names.withColumn("key", F.explode(F.when(few, F.concat(one, each_two(kinds))).otherwise(F.concat(one, many))))


def _rare_tokens(names: DataFrame, budget: Column, order: Order) -> DataFrame:
    """Keys of a name's rarest tokens of which a partner surely has one, or two, when tokens of ``budget`` characters may lack."""
    ranked = F.sort_array(F.transform("kinds", order.ranked))
    cost = lambda t: F.char_length(t) - 3  # noqa: E731  a blank instead of the rank
    total = lambda ts: F.aggregate(ts, F.lit(0), lambda s, t: s + cost(t))
    greatest = lambda ts: F.aggregate(ts, F.lit(0), lambda s, t: F.greatest(s, cost(t)))
    plain = lambda t: F.substring(t, F.lit(5), F.char_length(t))
    before = lambda ts, i: F.slice(ts, F.lit(1), i)
    first = let(ranked, lambda ts: F.filter(ts, lambda t, i: total(before(ts, i)) <= budget))
    pairs = let(ranked, lambda ts: F.filter(ts, lambda t, i: total(before(ts, i)) - greatest(before(ts, i)) <= budget))
    paired = let(ranked, lambda ts: (F.size(ts) <= MOST_TOKENS) & (total(ts) - greatest(ts) > budget))
    # The tokens of a key stand in the order of the other side's keys.
    two = each_two(F.sort_array(F.transform(pairs, plain)))
    one = F.transform(first, lambda t: F.xxhash64(F.lit("one"), plain(t)))
    many = F.transform(first, lambda t: F.xxhash64(F.lit("many"), plain(t)))
    return names.withColumn("key", F.explode(F.when(paired, F.concat(two, many)).otherwise(one)))


def covered_pairs(wanted: DataFrame, contacts: DataFrame, own: float, kept: Fresh | None = None) -> DataFrame:
    """Pairs of which one name's tokens, or all but very short ones, stand in the other: ``name, size, contact_size, contact_pos, own``.

    ``own`` is the ratio of the shared tokens to all of that name, ``own`` at least.
    """
    share = own / 100
    kept = kept or Fresh()
    order = kept.order("tokens", lambda: Order(contacts.select("kinds")))
    budget = F.char_length("flat") * (2 - 2 * share) / (2 - share) + 1e-6
    columns = ["size", "kinds", "flat"]
    sides = (wanted.select("name", *columns), contacts.select("contact_pos", *columns))
    found = []
    for inner, outer in (sides, sides[::-1]):
        # Of the two sides of each join the contacts are the kept one.
        if "name" in inner.columns:
            probes, table = _rare_tokens(inner, budget, order), kept.table("all tokens", ["key"], lambda: _all_tokens(outer))
        else:
            probes, table = kept.table(f"rare tokens {share}", ["key"], lambda: _rare_tokens(inner, budget, order)), _all_tokens(outer)
        table = table.withColumnsRenamed({c: f"other_{c}" for c in columns}).drop("other_flat")
        met = probes.join(table, "key")
        part = F.char_length(F.array_join(F.array_intersect("kinds", "other_kinds"), " "))
        whole = F.char_length("flat")
        ratio = F.when(part == whole, F.lit(100.0)).otherwise(F.lit(100.0) - F.lit(100.0) * (whole - part) / (part + whole))
        size, contact_size = ("size", "other_size") if "name" in inner.columns else ("other_size", "size")
        found.append(met.select("name", F.col(size).alias("size"), F.col(contact_size).alias("contact_size"), "contact_pos", ratio.alias("own")))
    return found[0].unionByName(found[1]).where(F.col("own") >= own - 1e-6)
