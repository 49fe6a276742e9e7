"""Best fuzzy match per name: an exact Jaro-Winkler join that compares few pairs.

Scores are rounded to twelve places, so that a similarity equal to the threshold is never
lost to the last bit; beyond that nothing is approximate. For a similarity of at least
``t`` and a common prefix of ``p`` characters, the Jaro part must reach
``j = (t - 0.1 p) / (1 - 0.1 p)``, which bounds

* the lengths: ``shorter / longer >= 3 j - 2``, and
* the characters in common: ``m >= (3 j - 1) a b / (a + b)`` for lengths ``a`` and ``b``.

Two families of keys bring the pairs together that can pass: names with the same first
character (``p`` up to 4) and all others (``p = 0``), each by bands of similar length. A
pair that meets is tested with bit masks inside the join, and only what is left is scored.

With a registry too large to broadcast, a key also holds one character token (a character
and its how-maniest occurrence). If two bags of ``a`` and ``b`` tokens share ``m``, then
the ``a - m + 1`` rarest of one and the ``b - m + 1`` rarest of the other share at least
one (prefix filtering of set-similarity joins), so only these become keys. A key so
frequent that one task could not compare it is spread over a grid of cells.

The lower the threshold, the more pairs are left to be scored. Where only the best match counts,
names are held against a higher threshold first, and those that reach it are done: every
pair at least as good was scored there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from probity.sources.layers import stage

from .similarity import PREFIX_LENGTH, PREFIX_WEIGHT, jaro_winkler

MIN_QUERY_LENGTH = 3
LONGEST = 1 << 30  # stands for no bound on a length
STEP, HIGHEST = 0.06, 0.86  # least step between the thresholds that names are held against, and where they begin
BROADCAST_NAMES = 20_000
BROADCAST_BYTES = 4 << 20
CELL_ROWS = 20_000
PAIRS_PER_TASK = 50_000_000
MAX_TASKS = 20_000

_CLASSES = 64  # characters are counted by code point modulo this: one bit each in a mask
_MASKS = 4  # mask k holds the characters that occur at least k times
_TOKEN_REPEATS = 16
_TOLERANCE = 1e-9
_BAND_GROWTH = 1.1


def best_matches(
    names: DataFrame,
    choices: DataFrame,
    threshold: float = 0.92,
    broadcast_names: int = BROADCAST_NAMES,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """For each distinct ``name`` of ``names`` its most similar ``name`` in ``choices``.

    Returns ``name, match, score`` for scores of at least ``threshold``; of equal scores the
    smallest match wins. Names shorter than three characters are not looked up. Any threshold
    above 0 will do; the lower it is the less the bounds hold off, until all that have a
    character in common are scored.
    """
    long_enough = names.select("name").where(F.length("name") >= MIN_QUERY_LENGTH).distinct()
    names = stage(_signatures(_checked(long_enough, threshold)), "names")
    choices = stage(_signatures(choices.select("name").where(F.length("name") > 0).distinct()), "choices")
    same = names.join(choices.select("name"), "name").select(
        "name", F.col("name").alias("match"), F.lit(1.0).alias("score")
    )
    rest = names.join(choices.select("name"), "name", "left_anti")
    found = same
    for level in _levels(threshold):
        scored = _scored(rest, names, choices, level, broadcast_names, cell_rows)
        best = (
            scored.groupBy("name")
            .agg(F.min(F.struct((-F.col("score")).alias("s"), "match")).alias("best"))
            .select("name", F.col("best.match").alias("match"), (-F.col("best.s")).alias("score"))
        )
        if level > threshold:
            best = stage(best, "best-matches")
            rest = rest.join(best.select("name"), "name", "left_anti")
        found = found.unionByName(best)
    return found


def similar_pairs(
    names: DataFrame,
    threshold: float = 0.92,
    broadcast_names: int = BROADCAST_NAMES,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``name, match, score`` of all pairs of different names that are so similar, each once, the smaller name first.

    Names shorter than three characters, and null, are in no pair.
    """
    names = names.select("name").where(F.length("name") >= MIN_QUERY_LENGTH).distinct()
    names = stage(_signatures(_checked(names, threshold)), "names")
    scored = _scored(names, names, names, threshold, broadcast_names, cell_rows)
    # the measure may see two names differently from either side, by the order of what it matches
    both = scored.select(F.least("name", "match").alias("name"), F.greatest("name", "match").alias("match"), "score")
    return both.where("name < match").groupBy("name", "match").agg(F.max("score").alias("score"))


def _checked(names: DataFrame, threshold: float) -> DataFrame:
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie above 0 and not above 1")
    return names


def _levels(threshold: float) -> list[float]:
    """Thresholds from ``HIGHEST`` down in steps that double, the one asked for last."""
    levels, step = [threshold], STEP
    while levels[0] + step <= HIGHEST + _TOLERANCE:
        levels.insert(0, levels[0] + step)
        step *= 2
    return levels


def _scored(
    asked: DataFrame, names: DataFrame, choices: DataFrame, threshold: float, broadcast_names: int, cell_rows: int
) -> DataFrame:
    """``name, match, score`` of all pairs that reach the threshold; ``asked`` are some of ``names``."""
    n_names, longest_name, _ = _size(names)
    n_choices, longest_choice, choice_bytes = _size(choices)
    bands = _length_bands(max(longest_name, longest_choice))
    # names are light and comparing them is not, so they are spread by work and not by bytes
    cores = names.sparkSession.sparkContext.defaultParallelism
    tasks = min(max(cores, n_names * n_choices // PAIRS_PER_TASK), MAX_TASKS)
    asked = asked.repartition(min(tasks, max(n_names, 1)), "name")
    if n_choices <= broadcast_names and choice_bytes <= BROADCAST_BYTES:
        pairs = _pairs_by_length(asked, choices, threshold, bands)
    else:
        choices = choices.repartition(min(tasks, max(n_choices, 1)), "name")
        pairs = _pairs_by_token(asked, choices, threshold, bands, cell_rows, tasks)
    scored = pairs.select("name", "match", jaro_winkler("name", "match").alias("score"))
    return scored.where(F.col("score") >= threshold)


def _size(names: DataFrame) -> tuple[int, int, int]:
    n, longest, size = names.agg(F.count("*"), F.max("n"), F.sum(F.octet_length("name"))).first()
    return n, longest or 1, size or 0


# ---------------------------------------------------------------- bounds


def _common_bound(threshold: float, prefix: int) -> float:
    """The ``3 j - 1`` of the module text."""
    boost = PREFIX_WEIGHT * prefix
    return 3 * (threshold - boost) / (1 - boost) - 1


def _families(threshold: float) -> list[tuple[int, float]]:
    """Family number and bound: 0 for different first characters, 1 for the same."""
    return [(0, _common_bound(threshold, 0)), (1, _common_bound(threshold, PREFIX_LENGTH))]


def _length_bands(longest: int) -> list[tuple[int, int, int]]:
    """(number, shortest, longest) of bands that grow by a tenth, so their number is logarithmic."""
    bands, start = [], 1
    while start <= longest:
        end = max(start, int(start * _BAND_GROWTH))
        bands.append((len(bands), start, end))
        start = end + 1
    return bands


def _band_literal(bands: list[tuple[int, int, int]]) -> Column:
    rows = ", ".join(f"named_struct('i', {i}, 'lo', {lo}, 'hi', {hi})" for i, lo, hi in bands)
    return F.expr(f"array({rows})")


def _own_band(bands: Column) -> Column:
    return F.filter(bands, lambda b: F.col("n").between(b["lo"], b["hi"]))[0]["i"]


def _shortest_partner(bound: float) -> Column:
    if bound <= 1:
        return F.lit(1)
    return F.ceil(F.col("n") * F.lit(bound - 1) - _TOLERANCE).cast("int")


def _longest_partner(bound: float) -> Column:
    if bound <= 1 + _TOLERANCE:
        return F.lit(LONGEST)
    return F.least(F.floor(F.col("n") / F.lit(bound - 1) + _TOLERANCE), F.lit(LONGEST)).cast("int")


def _spare(bound: float, partner_length: Column) -> Column:
    """How many characters may stay without partner, next to a name of at least this length.

    One is always in common, or the similarity is zero.
    """
    n = F.col("n")
    common = F.ceil(F.lit(bound) * n * partner_length / (n + partner_length) - _TOLERANCE)
    return (n - F.greatest(common, F.lit(1))).cast("int")


def _partner_bands(bands: Column, bound: float) -> Column:
    """Bands that hold a possible partner, with the shortest possible length in each."""
    shortest = _shortest_partner(bound)
    longest = _longest_partner(bound)
    reachable = F.filter(bands, lambda b: (b["hi"] >= shortest) & (b["lo"] <= longest))
    return F.transform(
        reachable, lambda b: F.struct(b["i"].alias("i"), F.greatest(b["lo"], shortest).alias("length"))
    )


# ---------------------------------------------------------------- signatures


def _classes(text: Column) -> Column:
    """The characters of a text as sorted numbers below 64."""
    characters = F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1))
    return F.sort_array(F.transform(characters, lambda c: F.ascii(c) % F.lit(_CLASSES)))


def _token_codes(classes: str) -> Column:
    """The bag of characters as numbers: class + 64 * (occurrence - 1)."""
    return F.transform(
        classes,
        lambda c, i: c
        + F.lit(_CLASSES)
        * F.least(i - F.array_position(classes, c).cast("int") + 1, F.lit(_TOKEN_REPEATS - 1)),
    )


def _signatures(names: DataFrame) -> DataFrame:
    """Length, heads, bags of characters and their masks for each name."""
    codes = F.col("codes")

    def mask(k: int) -> Column:
        here = F.filter(codes, lambda c: F.floor(c / _CLASSES) == k)
        return F.aggregate(
            here,
            F.lit(0).cast("bigint"),
            lambda bits, c: bits.bitwiseOR(
                F.call_function("shiftleft", F.lit(1).cast("bigint"), c % F.lit(_CLASSES))
            ),
        )

    parts = names.select(
        "name",
        F.length("name").alias("n"),
        _head(),
        _classes(F.col("name")).alias("classes"),
        _classes(F.expr("substring(name, 2)")).alias("rest"),
    ).withColumns({"codes": _token_codes("classes"), "rest_codes": _token_codes("rest")})
    masks = [mask(k).alias(f"mask{k}") for k in range(_MASKS)]
    return parts.select("name", "n", "head", "codes", "rest_codes", *masks)


def _head() -> Column:
    """The first characters in one number, sixteen bits of each; the first is the lowest."""
    packed = F.lit(0).cast("bigint")
    for place in range(PREFIX_LENGTH):
        character = F.ascii(F.substring("name", place + 1, 1)).cast("bigint")
        packed = packed.bitwiseOR(F.shiftleft(character.bitwiseAND(F.lit(0xFFFF)), 16 * place))
    return packed.alias("head")


def _can_pass(threshold: float) -> Column:
    """Whether the bags of two names share enough to reach the threshold.

    A bit set in the masks of one side only is at least one character without partner, so
    the shared characters are never underrated. They are held against what the key allows,
    which is whole numbers and drops nearly all, then against the exact lengths and starts.
    """

    def alone(this: str, that: str) -> Column:
        bits = [
            F.bit_count(
                F.col(f"{this}.mask{k}").bitwiseAND(F.bitwise_not(F.col(f"{that}.mask{k}")))
            )
            for k in range(_MASKS)
        ]
        return sum(bits[1:], bits[0])

    allowed = (alone("q", "r") <= F.col("q.spare")) & (alone("r", "q") <= F.col("r.spare"))

    a, b = F.col("q.n"), F.col("r.n")
    differs = F.col("q.head").bitwiseXOR(F.col("r.head"))

    def other_start(length: int) -> Column:
        return differs.bitwiseAND(F.lit((1 << 16 * length) - 1)) != 0

    bound = F.when(other_start(1), _common_bound(threshold, 0))
    for prefix in range(1, PREFIX_LENGTH - 1):
        bound = bound.when(other_start(prefix + 1), _common_bound(threshold, prefix))
    bound = bound.when(differs != 0, _common_bound(threshold, PREFIX_LENGTH - 1))
    bound = bound.otherwise(_common_bound(threshold, PREFIX_LENGTH)) - _TOLERANCE

    enough = F.least(a - alone("q", "r"), b - alone("r", "q")) * (a + b) >= bound * a * b
    return allowed & ((F.col("q.family") == 1) | other_start(1)) & enough


def _key(family: int, *parts: Column) -> Column:
    """Family, first character where it is shared, and further parts as one number.

    Two keys of one hash only let a few pairs meet that the test then drops.
    """
    first = F.col("head").bitwiseAND(F.lit(0xFFFF)) if family else F.lit(-1)
    return F.xxhash64(F.lit(family), first, *parts)


def _place(family: int, key: Column, spare: Column) -> Column:
    return F.struct(F.lit(family).alias("family"), key.alias("key"), spare.alias("spare"))


def _unfolded(names: DataFrame, places: Column) -> DataFrame:
    """One row per name and place, holding what the pair test needs.

    None of it is ever null, and saying so spares the test a check per value.
    """
    rows = names.select("name", "n", "head", *[f"mask{k}" for k in range(_MASKS)], F.inline(places))
    return rows.select("name", *[F.coalesce(c, F.lit(0)).alias(c) for c in rows.columns[1:]])


# ---------------------------------------------------------------- small registry


def _pairs_by_length(names: DataFrame, choices: DataFrame, threshold: float, bands) -> DataFrame:
    """Registry of checked size: broadcast, looked up by family, head and length band."""
    band_list = _band_literal(bands)

    def wanted(family: int, bound: float) -> Column:
        return F.transform(
            _partner_bands(band_list, bound),
            lambda b: _place(family, _key(family, b["i"]), _spare(bound, b["length"])),
        )

    def offered(family: int, bound: float) -> Column:
        return _place(family, _key(family, _own_band(band_list)), _spare(bound, _shortest_partner(bound)))

    families = _families(threshold)
    q = _unfolded(names, F.concat(*[wanted(*f) for f in families]))
    r = _unfolded(choices, F.array(*[offered(*f) for f in families])).drop("family")
    met = q.alias("q").join(F.broadcast(r).alias("r"), [F.col("q.key") == F.col("r.key"), _can_pass(threshold)])
    return met.select(F.col("q.name").alias("name"), F.col("r.name").alias("match"))


# ---------------------------------------------------------------- large registry

def _pairs_by_token(
    names: DataFrame, choices: DataFrame, threshold: float, bands, cell_rows: int, tasks: int
) -> DataFrame:
    """Registry of any size: both sides shuffled by prefix-filter keys."""
    ranks = _token_ranks(choices)
    q = _keyed(names, threshold, bands, ranks, names_first=True)
    r = _keyed(choices, threshold, bands, ranks, names_first=False).drop("family")

    q_count = q.groupBy("key").agg(F.count("*").alias("q_rows"))
    r_count = r.groupBy("key").agg(F.count("*").alias("r_rows"))
    cells = (F.ceil(F.col("q_rows") / cell_rows).cast("int"), F.ceil(F.col("r_rows") / cell_rows).cast("int"))
    hot = stage(
        q_count.join(r_count, "key")
        .select("key", cells[0].alias("q_cells"), cells[1].alias("r_cells"))
        .where("q_cells > 1 OR r_cells > 1"),
        "hot-keys",
    )
    q = _spread(q, hot, own="q_cell", own_cells="q_cells", other="r_cell", other_cells="r_cells")
    r = _spread(r, hot, own="r_cell", own_cells="r_cells", other="q_cell", other_cells="q_cells")
    q, r = q.repartition(tasks, "key"), r.repartition(tasks, "key")
    met = q.alias("q").join(r.alias("r"), [F.col("q.key") == F.col("r.key"), _can_pass(threshold)])
    # a pair can meet at several tokens
    return met.select(F.col("q.name").alias("name"), F.col("r.name").alias("match")).distinct()


def _token_ranks(choices: DataFrame) -> Column:
    """Place of each token from rare to frequent; there are at most 1024 tokens to count."""
    counted = (
        choices.select(F.explode(F.array_distinct("codes")).alias("code"))
        .groupBy("code")
        .count()
        .collect()
    )
    frequency = {row.code: row["count"] for row in counted}
    codes = sorted(range(_CLASSES * _TOKEN_REPEATS), key=lambda code: (frequency.get(code, 0), code))
    place = {code: i for i, code in enumerate(codes)}
    return F.expr(f"array({', '.join(str(place[code]) for code in range(len(codes)))})")


def _keyed(names: DataFrame, threshold: float, bands, ranks: Column, names_first: bool) -> DataFrame:
    band_list = _band_literal(bands)

    def ranked(codes: Column) -> Column:
        return F.sort_array(F.transform(codes, lambda c: F.get(ranks, c)))

    def keys(family: int, bound: float) -> Column:
        # the shared first character says nothing inside its own block
        tokens = F.col("rest_tokens" if family else "tokens")

        def of_band(b: Column) -> Column:
            lengths = (F.col("band"), b["i"]) if names_first else (b["i"], F.col("band"))
            spare = _spare(bound, b["length"])
            rarest = F.slice(tokens, 1, F.greatest(spare + 1, F.lit(0)))
            if family:
                # where the first character may be all that is shared, all names of it meet
                alone = F.when(spare >= F.col("n") - 1, F.array(F.lit(-1))).otherwise(F.array().cast("array<int>"))
                rarest = F.concat(rarest, alone)
            return F.transform(
                F.array_distinct(rarest),
                lambda token: _place(family, _key(family, *lengths, token), spare),
            )

        return F.flatten(F.transform(_partner_bands(band_list, bound), of_band))

    ready = names.select(
        "*",
        _own_band(band_list).alias("band"),
        ranked(F.col("codes")).alias("tokens"),
        ranked(F.col("rest_codes")).alias("rest_tokens"),
    )
    return _unfolded(ready, F.concat(*[keys(*f) for f in _families(threshold)]))


def _spread(
    side: DataFrame, hot: DataFrame, own: str, own_cells: str, other: str, other_cells: str
) -> DataFrame:
    """Places rows of a hot key in one line of its grid of cells; other keys stay as they are."""
    cells = F.coalesce(own_cells, F.lit(1))
    line = F.sequence(F.lit(0), F.coalesce(other_cells, F.lit(1)) - 1)
    placed = (
        side.join(hot, "key", "left")
        .withColumn(own, F.pmod(F.xxhash64("name"), cells).cast("int"))
        .withColumn(other, F.explode(line))
    )
    cell_key = F.when(F.col(own_cells).isNull(), F.col("key")).otherwise(F.xxhash64("key", "q_cell", "r_cell"))
    return placed.withColumn("key", cell_key).drop(own, other, own_cells, other_cells)


