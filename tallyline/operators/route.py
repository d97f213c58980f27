"""Routing: every order to every definition that wants its event type and finds its dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tallyline.functions.script import CURRENT, RESERVED, Path
from tallyline.functions.text import as_input, as_text, choose, is_blank
from tallyline.sources.definitions import DefinitionSet

#: Copies that a stream keeps of a definition table too large to broadcast, as it cannot be measured beforehand.
SALTS = 64
#: Orders of one event type in a backfill from which its definitions are copied.
SPREAD = 1_000_000
_ROUTED = (
    "def_ord",
    "ref_ord",
    "ref_name",
    "slice_granularity",
    "slice_seconds",
    "window_slices",
    "script_id",
    "params",
    "slots",
    "fold",
    "n_dims",
)


def join_definitions(left: DataFrame, table: DataFrame, key: str, definitions: DefinitionSet) -> DataFrame:
    """Inner join with definition rows: by broadcast within the size bound, else by shuffle.

    A backfill's shuffle join leaves keys with many rows to Spark, which splits them at run time; a stream, where it
    does not, spreads every key over copies of the table.
    """
    if definitions.small:
        return left.join(F.broadcast(table), key)
    if not left.isStreaming:
        return left.join(table, key)
    copies = F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")
    salted = left.withColumn("salt", F.pmod(F.xxhash64("order_id", "arrival_seq"), F.lit(SALTS)))
    return salted.join(table.withColumn("salt", F.explode(copies)), [key, "salt"]).drop("salt")


def frequent_keys(keyed: DataFrame) -> dict[str, int]:
    """Route keys that hold more than a quarter of a core's share of a backfill's orders, and how many shares each has.

    There can be four times as many as cores at most.
    """
    shares = 4 * keyed.sparkSession.sparkContext.defaultParallelism
    counts = keyed.groupBy("route_key").count()
    seen = Observation()
    top = counts.observe(seen, F.coalesce(F.sum("count"), F.lit(0)).alias("all")).orderBy(F.desc("count")).limit(shares)
    found = top.collect()
    share = max(SPREAD, seen.get["all"] // shares)
    return {r["route_key"]: -(-r["count"] // share) for r in found if r["count"] > share}


def _join_routes(keyed: DataFrame, table: DataFrame, definitions: DefinitionSet) -> DataFrame:
    """Orders with the definitions of their route key; frequent keys are spread over as many copies as they need."""
    frequent = {} if definitions.small or keyed.isStreaming else frequent_keys(keyed)
    if not frequent:
        return join_definitions(keyed, table, "route_key", definitions)
    salts = keyed.sparkSession.createDataFrame(list(frequent.items()), "route_key string, salts bigint")

    def salted(rows: DataFrame, salt: Column) -> DataFrame:
        return rows.join(F.broadcast(salts), "route_key", "left").withColumn("salt", salt).drop("salts")

    known = F.coalesce("salts", F.lit(1))
    left = salted(keyed, F.pmod(F.xxhash64("order_id", "arrival_seq"), known))
    right = salted(table, F.explode(F.sequence(F.lit(0).cast("bigint"), known - 1)))
    return left.join(right, ["route_key", "salt"]).drop("salt")


def _leaf(orders: DataFrame, name: str) -> tuple[Column, T.DataType]:
    """A field of the order and its type, from a struct or a map of fields."""
    kind = orders.schema["fields"].dataType
    if isinstance(kind, T.MapType):
        return F.try_element_at("fields", F.lit(name)), kind.valueType
    if name in kind.fieldNames():
        return F.col("fields").getField(name), kind[name].dataType
    return F.lit(None).cast("string"), T.StringType()


def _input_value(orders: DataFrame, path: Path, wanted: str) -> Column:
    value, kind = _leaf(orders, path[0])
    if len(path) > 1:
        if not isinstance(kind, T.VariantType):
            return F.lit(None).cast(wanted)
        steps = "".join("['" + step.replace("'", "\\'") + "']" for step in path[1:])
        value = F.try_variant_get(value, "$" + steps, "variant")
    return as_input(value, kind, wanted)


def input_columns(definitions: DefinitionSet) -> dict[tuple[Path, str], str]:
    """Column name for every distinct (name, type) that a script reads, in the order of their numbers."""
    return {pair: f"{RESERVED}in_{n}" for n, pair in enumerate(definitions.inputs)}


OVERRIDDEN = f"{RESERVED}overridden"


def may_override(orders: DataFrame, definitions: DefinitionSet) -> bool:
    """Whether an order can bring a field called ``current`` that some script reads."""
    kind = orders.schema["fields"].dataType
    return definitions.reads_current and (isinstance(kind, T.MapType) or CURRENT in kind.fieldNames())


def _bind_inputs(orders: DataFrame, definitions: DefinitionSet) -> DataFrame:
    """Script inputs as columns, read once per order and before it fans out.

    An order field called ``current`` takes the place of the slice value.
    """
    current, _ = _leaf(orders, CURRENT)
    overridden = current.isNotNull() if may_override(orders, definitions) else F.lit(False)
    columns = {}
    for (path, wanted), name in input_columns(definitions).items():
        value = _input_value(orders, path, wanted)
        if path == (CURRENT,):
            value = F.when(current.isNull(), F.lit(0.0).cast(wanted)).otherwise(value)
        columns[name] = value
    return orders.withColumns({**columns, OVERRIDDEN: overridden})


def pair_by_event(orders: DataFrame, definitions: DefinitionSet) -> DataFrame:
    """Orders joined with the definitions that accept their event type, dimensions not yet checked.

    The event type is an equality key, so this is a hash join.  A definition without event types is
    listed under every known code and under ``*``, the key of all other orders, so each order has one
    key.  Where the codes are too many to list, orders carry ``*`` as a second key instead.
    """
    code = F.col("event_type_code")
    known = definitions.event_codes
    named = orders.where(~is_blank(code))
    typed_key = F.concat(F.lit("="), code)
    if known is None:
        keyed = _bind_inputs(named, definitions)
        both = F.explode(F.array(typed_key, F.lit("*")))
        keyed = keyed.withColumn("route_key", both if definitions.any_event else typed_key)
    elif definitions.any_event:
        # Never an empty list: a key that is the same for all orders would not be a join key.
        listed = code.isin(*known or ("",))
        key = F.when(listed, typed_key).otherwise(F.lit("*"))
        keyed = _bind_inputs(named, definitions).withColumn("route_key", key)
    else:
        # Known codes as a plain filter, which reaches a columnar scan.
        wanted = orders.where(code.isin(*known)) if known else orders.where(F.lit(False))
        keyed = _bind_inputs(wanted.where(~is_blank(code)), definitions).withColumn("route_key", typed_key)
    table = definitions.table.withColumn("route_key", F.explode("route_keys")).drop("route_keys", "acc_script")
    return _join_routes(keyed, table, definitions).drop("route_key")


def _dimension_values(pairs: DataFrame, definitions: DefinitionSet) -> list[Column]:
    """Text of each numbered dimension: a choice among the named fields, by number."""
    values = []
    for i in range(definitions.max_dimensions):
        options = ((n, as_text(*_leaf(pairs, d))) for n, d in enumerate(definitions.dimension_names))
        values.append(choose(F.col(f"dim_{i}"), options, F.lit(None).cast("string")))
    return values


def _label(i: int) -> Column:
    return F.col(f"label_{i}")


def dimension_key(values: Sequence[Column]) -> Column:
    """One dimension: its bare value.  Several: ``d1#v1;d2#v2``.  None: empty."""
    if not values:
        return F.lit("")
    several = F.concat_ws(";", *[F.concat(_label(i), v) for i, v in enumerate(values)])
    return F.when(F.col("n_dims") == 1, values[0]).otherwise(several)


def legacy_dimension_key(values: Sequence[Column]) -> Column:
    """The older form ``d1#v1;d2#v2;`` in which an absent value prints as ``null``."""
    parts = [F.concat(_label(i), F.coalesce(v, F.lit("null")), F.lit(";")) for i, v in enumerate(values)]
    return F.concat_ws("", *parts) if parts else F.lit("")


def with_legacy_keys(pairs: DataFrame, definitions: DefinitionSet) -> DataFrame:
    return pairs.withColumn("legacy_key", legacy_dimension_key(_dimension_values(pairs, definitions)))


def route(orders: DataFrame, definitions: DefinitionSet) -> DataFrame:
    """One row per order and matching definition, with its dimension key and script inputs."""
    pairs = pair_by_event(orders, definitions)
    values = _dimension_values(pairs, definitions)
    names = [f"value_{i}" for i in range(len(values))]
    narrow = pairs.select(
        "order_id",
        "event_epoch_ms",
        "arrival_seq",
        *_ROUTED,
        *[f"label_{i}" for i in range(len(values))],
        *[v.alias(n) for v, n in zip(values, names)],
        *input_columns(definitions).values(),
        OVERRIDDEN,
    )
    for i, name in enumerate(names):
        narrow = narrow.where(_label(i).isNull() | F.col(name).isNotNull())
    keyed = narrow.withColumn("dimension_key", dimension_key([F.col(n) for n in names]))
    return keyed.drop("n_dims", *names, *[f"label_{i}" for i in range(len(names))])
