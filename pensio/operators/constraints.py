"""Table constraints as data-quality rules, and the validated append that keeps every rejected row."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql import types as T

from pensio.operators.ordering import in_pieces, numbered, place_in_pieces, rank
from pensio.session import scratch_dir
from pensio.sources.snapshots import publish, stage, unstage

# Public error numbers of the source database for each kind of rule.
ERROR_NUMBERS = {
    "not_null": 1400, "digits": 1438, "length": 12899, "check": 2290, "unique": 1, "foreign_key": 2291,
}


@dataclass(frozen=True)
class NotNull:
    column: str
    kind = "not_null"

    @property
    def name(self):
        return f"{self.column} is null"

    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Digits:
    """A whole number of at most ``digits`` digits."""

    column: str
    digits: int
    kind = "digits"

    @property
    def name(self):
        return f"{self.column} has more than {self.digits} digits"

    def broken(self) -> Column:
        return F.coalesce(F.abs(F.col(self.column)) >= F.lit(10**self.digits), F.lit(False))


@dataclass(frozen=True)
class Length:
    """A text of at most ``size`` characters."""

    column: str
    size: int
    kind = "length"

    @property
    def name(self):
        return f"{self.column} is longer than {self.size}"

    def broken(self) -> Column:
        return F.coalesce(F.length(self.column) > self.size, F.lit(False))


@dataclass(frozen=True)
class Check:
    """``condition`` (SQL text) must not be false; unknown passes."""

    label: str
    condition: str
    kind = "check"

    @property
    def name(self):
        return self.label

    def broken(self) -> Column:
        return ~F.coalesce(F.expr(self.condition), F.lit(True))


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]
    kind = "unique"

    @property
    def name(self):
        return f"unique ({', '.join(self.columns)})"


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: DataFrame
    parent_columns: tuple[str, ...]
    kind = "foreign_key"

    @property
    def name(self):
        return f"parent of ({', '.join(self.columns)})"


Rule = NotNull | Digits | Length | Check | Unique | ForeignKey


def _key(columns) -> Column:
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)])


def any_present(columns) -> Column:
    """A wholly NULL key never collides, a partly NULL one does."""
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns])


def _row_rules(df: DataFrame, rules) -> DataFrame:
    """Adds ``_broken``: names of the broken rules that need at most a look at a parent table."""
    frame, names = df, []
    for i, rule in enumerate(rules):
        if isinstance(rule, ForeignKey):
            parent = rule.parent.select(
                *[F.col(p).alias(c) for p, c in zip(rule.parent_columns, rule.columns)]
            )
            listed = parent.dropna().distinct().withColumn(f"_parent{i}", F.lit(True))
            frame = frame.join(listed, list(rule.columns), "left")
            complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule.columns])
            names.append(F.when(complete & F.col(f"_parent{i}").isNull(), rule.name))
        elif not isinstance(rule, Unique):
            names.append(F.when(rule.broken(), rule.name))
    found = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return frame.select(*df.columns, found.alias("_broken"))


def check_constraints(df: DataFrame, rules: list[Rule], key: list[str]) -> DataFrame:
    """(rule, key columns): one row per row and broken rule of a table as it stands.

    Every row of a repeated unique key is reported. Repeats are counted with a map-side aggregate and only the
    repeated keys meet the table again.
    """
    found = (
        _row_rules(df, rules)
        .where(F.size("_broken") > 0)
        .select(F.explode("_broken").alias("rule"), *key)
    )
    for rule in rules:
        if isinstance(rule, Unique):
            keyed = df.where(any_present(rule.columns)).withColumn("_key", _key(rule.columns))
            repeated = keyed.groupBy("_key").count().where("count > 1").select("_key")
            found = found.unionByName(
                keyed.join(repeated, "_key", "left_semi").select(F.lit(rule.name).alias("rule"), *key)
            )
    return found


def reject_schema(table: T.StructType) -> T.StructType:
    """Layout of a reject table: error number, message, operation and tag, then the columns as text."""
    head = T.StructType(
        [
            T.StructField("error_number", T.IntegerType()),
            T.StructField("error_message", T.StringType()),
            T.StructField("error_operation", T.StringType()),
            T.StructField("error_tag", T.StringType()),
        ]
    )
    return T.StructType(head.fields + [T.StructField(f.name, T.StringType()) for f in table.fields])


# Tables with a reject table, and its name where it is not the default one.
REJECT_TABLES = (
    ("ASSIGNMENTS", None),
    ("ACCOUNTS_BALANCE", None),
    ("DOCUMENTS", "ERR$_IMP_DOCUMENTS"),
    ("CONTRACTS", "ERR$_IMP_CONTRACTS"),
    ("PENSION_AGREEMENTS", "ERR$_IMP_PENSION_AGREEMENTS"),
    ("ACCOUNTS", "ERR$_IMP_ACCOUNTS"),
    ("PAY_ORDERS", "ERR$_IMP_PAY_ORDERS"),
    ("ASSIGNMENTS", "ERR$_IMP_ASSIGNMENTS"),
    ("PAY_PORTFOLIOS", "ERR$_IMP_PAY_PORTFOLIOS"),
    ("PAY_DECISIONS", "ERR$_IMP_PAY_DECISIONS"),
    ("PENSION_AGREEMENT_ADDENDUMS", "ERR$_PENSION_AGREEMENT_ADDEND"),
    ("PAY_RESTRICTIONS", "ERR$_IMP_PAY_RESTRICTIONS"),
)


def reject_table_name(table: str, name: str | None = None) -> str:
    return (name or f"ERR$_{table}").upper()


@dataclass(frozen=True)
class Appended:
    """Both outcomes of an append and how many rows each has."""

    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def append_with_rejects(
    batch: DataFrame,
    rules: list[Rule],
    order: list[str],
    *,
    target: DataFrame | dict[str, DataFrame] | None = None,
    defaults: dict[str, Column] | None = None,
    ids: str | None = None,
    first_id: int = 1,
    tag: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of a batch appended to ``target``: every row ends up in exactly one of them.

    ``order`` decides which of several rows with the same unique key comes first; it must tell all rows apart. A
    row that breaks another rule does not occupy its unique key. ``ids`` is renumbered from ``first_id`` in that
    order, rejected rows using up numbers too, as a sequence does. A rejected row carries the first rule it
    breaks, in the order of ``rules``. ``target`` may be several DataFrames with the key columns of each unique rule, by
    the rule's name.
    """
    done = append(batch, rules, order, target=target, defaults=defaults, ids=ids, first_id=first_id, tag=tag)
    return done.accepted, done.rejected


def with_defaults(batch: DataFrame, defaults: dict[str, Column] | None) -> DataFrame:
    """``batch`` with the defaults in the place of what it does not bring."""
    return batch.select(
        *[F.coalesce(F.col(c), defaults[c]).alias(c) if defaults and c in defaults else F.col(c)
          for c in batch.columns]
    )


def append(
    batch: DataFrame,
    rules: list[Rule],
    order: list[str],
    *,
    target: DataFrame | dict[str, DataFrame] | None = None,
    defaults: dict[str, Column] | None = None,
    ids: str | None = None,
    first_id: int = 1,
    tag: str | None = None,
    number: str | None = None,
) -> Appended:
    """``append_with_rejects`` with the number of rows of each outcome.

    The batch is judged and written once, one folder an outcome, and counted by the same job. Each row is written with
    its place inside a range piece of the order; a number follows from the pieces' sizes when an outcome is read. With
    ``ids`` and unique rules the batch is numbered before: its numbers are then the places by which rivals are compared.
    ``number`` names a column of the batch that already holds them, from 1 on; it is in neither outcome.
    """
    frame = with_defaults(batch, defaults)
    columns = [c for c in frame.columns if c != number]
    unique = [r for r in rules if isinstance(r, Unique)]
    if ids:
        columns = columns if ids in columns else [ids, *columns]
        frame = frame.drop(ids)
        if unique and not number:
            number = "_number"
            frame = numbered(frame, order, number)
        elif not number:
            frame = in_pieces(frame, order)
        frame = frame.withColumn(ids, F.lit(None).cast("long"))
    judged = _row_rules(frame, rules).withColumn(
        "_error", F.when(F.size("_broken") > 0, F.col("_broken")[0])
    ).drop("_broken")
    place = [number] if number else order
    held = {r.name: target.get(r.name) if isinstance(target, dict) else target for r in unique}
    if len(unique) == 1:
        judged = _reject_repeats(judged, unique[0], F.col(number) if number else rank(order), held[unique[0].name])
    elif unique:
        for rule in unique:
            judged = _reject_existing(judged, rule, held[rule.name])
        judged = _reject_repeats_of_several(judged, unique, place)

    seen = Observation()
    good = F.col("_error").isNull()
    counted = judged.withColumn("_accepted", good).observe(
        seen, F.count_if(good).alias("accepted"), F.count_if(~good).alias("rejected")
    )
    written = publish(counted, scratch_dir(batch.sparkSession), ["_accepted"])
    if ids and number:
        written = written.withColumn(ids, F.col(number) + F.lit(first_id - 1).cast("long"))
    elif ids:
        written = place_in_pieces(written, ids, first_id)
    accepted = written.where("_accepted").select(*columns)
    numbers = F.create_map(*[F.lit(x) for r in rules for x in (r.name, ERROR_NUMBERS[r.kind])])
    rejected = written.where("not _accepted").select(
        numbers[F.col("_error")].alias("error_number"),
        F.col("_error").alias("error_message"),
        F.lit("I").alias("error_operation"),
        F.lit(tag).cast("string").alias("error_tag"),
        *[F.col(c).cast("string").alias(c) for c in columns],
    )
    return Appended(accepted, rejected, dict(seen.get))


def _reject_existing(judged: DataFrame, rule: Unique, target: DataFrame | None) -> DataFrame:
    """Marks rows whose unique key the target already holds."""
    if target is None:
        return judged
    taken = (
        target.where(any_present(rule.columns))
        .select(_key(rule.columns).alias("_key"))
        .distinct()
        .withColumn("_taken", F.lit(True))
    )
    return (
        judged.withColumn("_key", _key(rule.columns))
        .join(taken, "_key", "left")
        .withColumn("_error", F.when(F.col("_taken"), F.coalesce("_error", F.lit(rule.name))).otherwise(F.col("_error")))
        .drop("_key", "_taken")
    )


def _reject_repeats(judged: DataFrame, rule: Unique, place: Column, target: DataFrame | None) -> DataFrame:
    """Marks the faultless rows whose unique key the target holds, and all but the first of those that share a key.

    Both are found in one list of keys, so the rows are moved once. The first place per key is a map-side minimum: a key
    with very many rows leaves each task as one row.
    """
    contending = F.col("_error").isNull() & any_present(rule.columns)
    keys = judged.where(contending).select(*rule.columns, place.alias("_place"), F.lit(False).alias("_held"))
    if target is not None:
        no_place = F.lit(None).cast(keys.schema["_place"].dataType).alias("_place")
        held = target.where(any_present(rule.columns)).select(*rule.columns, no_place, F.lit(True).alias("_held"))
        keys = keys.union(held)
    first = (
        keys.groupBy(_key(rule.columns).alias("_key"))
        .agg(F.min("_place").alias("_first"), F.max("_held").alias("_taken"), F.count(F.lit(1)).alias("_rows"))
        .where("_rows > 1 or _taken")
        .drop("_rows")
    )
    lost = contending & (F.col("_taken") | (place > F.col("_first")))
    return (
        judged.join(first, _key(rule.columns) == F.col("_key"), "left")
        .withColumn("_error", F.when(lost, F.lit(rule.name)).otherwise(F.col("_error")))
        .drop("_key", "_first", "_taken")
    )


def _reject_repeats_of_several(judged: DataFrame, rules: list[Unique], order: list[str]) -> DataFrame:
    """The same for several unique keys, where a row rejected for one key leaves its other keys free.

    Rows without a rival in any key are settled in one pass; the batch is written once, and only the places and keys
    of the others go round. A row's fate is known once those of its earlier rivals are. Where it has only one, it is
    accepted if and only if that one is not: such rows form chains, and a chain is followed to its head by doubling,
    with the parity of its length, so a chain of n rows takes log2(n) steps. A phase accepts what its chains settle
    and rejects what shares a key with that; each step and phase writes what it found.

    What remains is decided by further phases: a row with two or more earlier rivals waits until they are decided, so
    there is a phase for every such row that stands behind another one in a dependency, each over what is left only.
    First come, first served over several keys is not known to have a plan of fewer rounds for those.
    """
    keys = [f"_k{i}" for i in range(len(rules))]
    bulk = judged
    for name, rule in zip(keys, rules):
        contending = F.col("_error").isNull() & any_present(rule.columns)
        key = _key(rule.columns) if len(rule.columns) > 1 else F.col(rule.columns[0])
        bulk = bulk.withColumn(name, F.when(contending, key))
    for i, name in enumerate(keys):
        repeated = (
            bulk.where(F.col(name).isNotNull()).groupBy(name).count().where("count > 1")
            .select(F.col(name).alias("_r"), F.lit(True).alias(f"_rival{i}"))
        )
        bulk = bulk.join(repeated, F.col(name) == F.col("_r"), "left").drop("_r")
    rivals = reduce(lambda a, b: a | b, [F.coalesce(f"_rival{i}", F.lit(False)) for i in range(len(rules))])
    bulk = stage(bulk.withColumn("_open", rivals).drop(*[f"_rival{i}" for i in range(len(rules))]))

    bulk = bulk.withColumn("_place", _place(bulk, order))

    rest, hits = bulk.where("_open").select("_place", *keys), []
    last = None
    while not rest.isEmpty():
        led = _chains(_earlier_rivals(rest, keys))
        taken_by = F.lit(None).cast("string")
        judged_now = led.where("not coalesce(_in, false)")
        for i, (name, rule) in reversed(list(enumerate(zip(keys, rules)))):
            held = led.where(F.col("_in") & F.col(name).isNotNull()).select(F.col(name).alias("_h")).distinct()
            held = held.withColumn(f"_hit{i}", F.lit(True))
            judged_now = judged_now.join(held, F.col(name) == F.col("_h"), "left").drop("_h")
            taken_by = F.when(F.col(f"_hit{i}"), F.lit(rule.name)).otherwise(taken_by)
        judged_now = stage(judged_now.select("_place", *keys, taken_by.alias("_hit")))
        hits.append(stage(judged_now.where("_hit is not null").select("_place", "_hit")))
        unstage(led)
        if last is not None:
            unstage(last)
        rest, last = judged_now.where("_hit is null").select("_place", *keys), judged_now
    bulk = bulk.drop(*keys, "_open")
    if not hits:
        return bulk.drop("_place")
    lost = reduce(DataFrame.unionByName, hits).select(F.col("_place").alias("_p"), "_hit")
    return (
        bulk.join(lost, F.col("_place") == F.col("_p"), "left")
        .withColumn("_error", F.coalesce("_error", "_hit"))
        .drop("_place", "_p", "_hit")
    )


def _place(staged: DataFrame, order: list[str]) -> Column:
    """A value that sorts as ``order`` does; the column itself where that is one whole number without a NULL, whose
    minima are kept in hash tables while those of structs need sorts."""
    whole = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    if len(order) == 1 and isinstance(staged.schema[order[0]].dataType, whole):
        if staged.where(F.col(order[0]).isNull()).isEmpty():
            return F.col(order[0]).cast("long")
    return rank(order)


def _earlier_rivals(rest: DataFrame, keys: list[str]) -> DataFrame:
    """``rest`` (_place, keys) with ``_up``, a row's only earlier rival, and ``_in``: true where it has none.

    Both are NULL for a row with several. The first and second place of each key are two map-side minima, so a key
    with very many rows leaves each task as one row.
    """
    frame, ups, more = rest, [], []
    for i, name in enumerate(keys):
        own = rest.where(F.col(name).isNotNull())
        first = own.groupBy(F.col(name).alias("_f")).agg(F.min("_place").alias(f"_first{i}"))
        later = own.join(first, F.col(name) == F.col("_f")).where(F.col("_place") > F.col(f"_first{i}"))
        second = later.groupBy(F.col(name).alias("_s")).agg(F.min("_place").alias(f"_second{i}"))
        frame = frame.join(first, F.col(name) == F.col("_f"), "left").drop("_f")
        frame = frame.join(second, F.col(name) == F.col("_s"), "left").drop("_s")
        ups.append(F.when(F.col("_place") > F.col(f"_first{i}"), F.col(f"_first{i}")))
        more.append(F.coalesce(F.col("_place") > F.col(f"_second{i}"), F.lit(False)))
    earlier = F.array_distinct(F.array_compact(F.array(*ups)))
    several = reduce(lambda a, b: a | b, more) | (F.size(earlier) > 1)
    return stage(
        frame.select(
            "_place", *keys, F.when(~several, F.get(earlier, F.lit(0))).alias("_up"),
            F.when(~several & (F.size(earlier) == 0), F.lit(True)).alias("_in"), F.lit(True).alias("_odd"),
        )
    )


def _chains(rows: DataFrame) -> DataFrame:
    """``rows`` (_place, _up, _in, _odd, more) with ``_in`` settled along the chains of ``_up``.

    A row is in where the head of its chain is and lies an even number of links away, or is out at an odd number; it
    stays NULL below a head that is undecided. Every step doubles the links that are skipped.
    """
    while not rows.where("_up is not null").isEmpty():
        rows, done = _skip(rows), rows
        unstage(done)
    return rows


def _skip(rows: DataFrame) -> DataFrame:
    """One step: a row takes over where its upper row points, or the fate of one that is a head."""
    upper = rows.select(F.col("_place").alias("_at"), F.col("_up").alias("_next"), F.col("_in").alias("_fate"), F.col("_odd").alias("_far"))
    linked = F.col("_up").isNotNull()
    ends = linked & F.col("_next").isNull()
    return stage(
        rows.join(upper, F.col("_up") == F.col("_at"), "left").select(
            *[c for c in rows.columns if c not in ("_up", "_in", "_odd")],
            F.when(linked, F.col("_next")).alias("_up"),
            F.when(ends, F.col("_fate") != F.col("_odd")).otherwise(F.col("_in")).alias("_in"),
            F.when(linked & ~ends, F.col("_odd") != F.col("_far")).otherwise(F.col("_odd")).alias("_odd"),
        )
    )
