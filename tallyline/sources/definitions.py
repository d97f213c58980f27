"""Indicator definitions: reading, normalising and the snapshot a plan is built from."""

from __future__ import annotations

import json
import logging
import time
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cached_property, partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyline.functions import slices
from tallyline.functions.script import CURRENT, FOLDS, RESERVED, Path, Script, compile_script
from tallyline.functions.template import Lifted, Shape, keywords_of, lift, name_slot, template_of
from tallyline.functions.text import as_text
from tallyline.session import stored

log = logging.getLogger(__name__)

ONLINE = "ONLINE"
#: What the reason of a refused load begins with.
REFUSED = "definitions refused: "
DEFAULT_SCRIPT = "current + 1"

# The built-in definitions used until a definition table was read.
BOOTSTRAP = (
    {
        "refName": "txn_cnt_1d",
        "eventTypeCodes": ["EVT_PAY_RESULT"],
        "dimensions": ["merchantId"],
        "windowDays": 1,
        "sliceGranularity": "DAY",
        "accScript": "current + 1",
    },
    {
        "refName": "txn_amount_1d",
        "eventTypeCodes": ["EVT_PAY_RESULT"],
        "dimensions": ["merchantId"],
        "windowDays": 1,
        "sliceGranularity": "DAY",
        "accScript": "current + amount",
    },
)

#: A definition table up to this size is held as a snapshot and broadcast.
BROADCAST_ROWS = 20_000
BROADCAST_BYTES = 32 * 1024 * 1024
#: Folders of stored definitions, below the shared one.
RANKS, SNAPSHOT = "definition-ranks", "definitions"
#: Event codes under which definitions for every event type may be listed one by one.
LISTED_CODES = 2_000


# ---------------------------------------------------------------- reading and normalising


def normalise_documents(documents: DataFrame) -> DataFrame:
    """JSON arrays of definition rows (column ``value``) to normalised definitions.

    A row that cannot be mapped ends the whole load, so that a half-read table is never used.
    """
    variant = F.parse_json("value").cast("array<variant>")
    file = F.col("file") if "file" in documents.columns else F.lit("")
    exploded = documents.select(
        file.alias("file"), F.monotonically_increasing_id().alias("doc"), F.posexplode(variant).alias("pos", "item")
    )
    rows = exploded.select(
        F.struct("file", "doc", "pos").alias("def_ord"),
        F.col("item").cast("map<string,variant>").alias("row"),
    )

    def get(name: str) -> Column:
        return F.try_element_at("row", F.lit(name))

    def text(name: str, absent: str) -> Column:
        printed = F.coalesce(as_text(get(name), T.VariantType()), F.lit("null"))
        return F.when(F.map_contains_key("row", name), printed).otherwise(F.lit(absent))

    days = get("windowDays")
    numeric_days = F.try_variant_get(days, "$", "double")
    is_number = F.substring(F.schema_of_variant(days), 1, 3).isin("BIG", "DOU", "FLO", "DEC")
    window_days = (
        F.when(days.isNull() | F.is_variant_null(days), F.lit(1))
        .when(is_number, numeric_days.cast("int"))
        .otherwise(F.raise_error(F.lit("windowDays is not a number")).cast("int"))
    )
    return _finish(
        rows.where(_is_online(as_text(get("status"), T.VariantType()))).select(
            "def_ord",
            text("refName", "null").alias("ref_name"),
            get("eventTypeCodes").cast("array<string>").alias("event_type_codes"),
            get("dimensions").cast("array<string>").alias("dimensions"),
            window_days.alias("window_days"),
            text("sliceGranularity", slices.DEFAULT_GRANULARITY).alias("slice_granularity"),
            text("accScript", DEFAULT_SCRIPT).alias("acc_script"),
            get("fieldTypes").cast("map<string,string>").alias("field_types"),
        ),
        in_order="file" not in documents.columns,
    )


def normalise_table(table: DataFrame) -> DataFrame:
    """Definition rows held as columns (a parquet or catalog table) to normalised definitions.

    In a table a missing value and a null are the same thing and take the default.
    """
    present = set(table.columns)

    def get(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in present else F.lit(None).cast(kind)

    order = F.struct(get("def_ord", "bigint").alias("given"), F.monotonically_increasing_id().alias("place"))
    return _finish(
        table.where(_is_online(get("status", "string"))).select(
            order.alias("def_ord"),
            F.coalesce(get("ref_name", "string"), F.lit("null")).alias("ref_name"),
            get("event_type_codes", "array<string>").alias("event_type_codes"),
            get("dimensions", "array<string>").alias("dimensions"),
            F.coalesce(get("window_days", "int"), F.lit(1)).alias("window_days"),
            get("slice_granularity", "string").alias("slice_granularity"),
            F.coalesce(get("acc_script", "string"), F.lit(DEFAULT_SCRIPT)).alias("acc_script"),
            get("field_types", "map<string,string>").alias("field_types"),
        )
    )


def _is_online(status: Column) -> Column:
    return F.coalesce(status, F.lit(ONLINE)) == ONLINE


def _finish(rows: DataFrame, in_order: bool = False) -> DataFrame:
    no_names = F.array().cast("array<string>")
    step = slices.step_seconds(F.col("slice_granularity"))
    return _ranked(rows, in_order).select(
        F.col("rank").alias("def_ord"),
        "ref_name",
        F.coalesce("event_type_codes", no_names).alias("event_type_codes"),
        F.coalesce("dimensions", no_names).alias("dimensions"),
        step.alias("slice_seconds"),
        slices.window_slices(F.col("window_days"), step).alias("window_slices"),
        slices.normalise_granularity(F.col("slice_granularity")).alias("slice_granularity"),
        "acc_script",
        F.coalesce("field_types", F.create_map().cast("map<string,string>")).alias("field_types"),
    )


def _ranked(rows: DataFrame, in_order: bool) -> DataFrame:
    """Add ``rank``, a definition's place in reading order: files stand by name, and no number is left out.

    Rows of several scan splits are dealt into ranges of that order and stored, so that both readings below see the
    same ranges; a row's rank is its place inside its range and the count of all ranges before.  Rows that stand
    ``in_order`` in their splits, and splits too, are stored as they lie: each split is a range.
    """
    order = F.col("def_ord").asc_nulls_last()
    place = F.monotonically_increasing_id()
    if rows.rdd.getNumPartitions() <= 1:
        return rows.sortWithinPartitions(order).withColumn("rank", place)
    ordered = rows if in_order else rows.repartitionByRange(order).sortWithinPartitions(order)
    # the upper bits of a place are its range, the lower 33 its number in there
    ranged = stored(ordered.withColumn("place", place), RANKS)
    split = F.shiftright("place", 33)
    before, known = [], 0
    for number, size in sorted(ranged.groupBy(split).count().collect()):  # one row for each range
        before.append((number, known))
        known += size
    starts = rows.sparkSession.createDataFrame(before, "range bigint, before bigint")
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ranged.join(F.broadcast(starts), split == F.col("range"))
    return numbered.withColumn("rank", F.col("before") + inside).drop("place", "range", "before")


def read_definitions(spark: SparkSession, path: str, source: str = "json") -> DataFrame:
    """Definitions from a folder of JSON arrays, or from any table format Spark reads."""
    if source == "json":
        return normalise_documents(
            spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
        )
    return normalise_table(spark.read.format(source).load(path))


def definitions_from_rows(spark: SparkSession, rows: Iterable[Mapping]) -> DataFrame:
    """Definitions given in Python, through the same mapping as a JSON document."""
    return normalise_documents(spark.createDataFrame([(json.dumps(list(rows)),)], "value string").coalesce(1))


# ---------------------------------------------------------------- the snapshot


class _Scripts:
    """The scripts of a definition list: one template for all of a form, other scripts by themselves."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.keywords = keywords_of(spark)
        self.scripts: list[Script] = []
        self.inputs: dict[tuple[Path, str], int] = {}
        #: Which inputs stand in for a template's names.
        self.options: dict[str, set[int]] = {}
        self._numbers: dict[object, int] = {}
        self._templates: dict[Shape, Script | None] = {}

    def lifted(self, text: str, types: Mapping[str, str]) -> Lifted | None:
        return lift(text, types, self.keywords)

    def add(self, text: str, types: Mapping[str, str], lifted: Lifted | None) -> tuple[int, Lifted | None]:
        """The number of a script's expression, and what was lifted out of it if that is a template."""
        if lifted and lifted.shape not in self._templates:
            self._templates[lifted.shape] = template_of(self.spark, lifted, text)
        template = self._templates[lifted.shape] if lifted else None
        if template is None:
            lifted = None
            key: object = (text, tuple(sorted(types.items())))
        else:
            key = lifted.shape
        if key not in self._numbers:
            self._numbers[key] = len(self.scripts)
            self.scripts.append(template or compile_script(self.spark, text, types))
            script = self.scripts[-1]
            if script.runs:
                for path, kind in script.inputs.items():
                    if lifted is None or not path[0].startswith(RESERVED):
                        self.input(path, kind)
        return self._numbers[key], lifted

    def input(self, path: Path, kind: str) -> int:
        return self.inputs.setdefault((path, kind), len(self.inputs))

    def slots(self, shape: Shape, names: Iterable[Path]) -> list[int]:
        """The inputs that a template's names are, in a definition that uses these."""
        found = []
        for i, (path, kind) in enumerate(zip(names, shape.kinds, strict=True)):
            number = self.input(path, kind)
            self.options.setdefault(name_slot(i, kind), set()).add(number)
            found.append(number)
        return found


@dataclass(frozen=True)
class DefinitionSet:
    """A consistent snapshot of definitions and what a plan needs to know about them.

    ``table`` has one row per definition with the columns routing needs.  A snapshot within
    the size bound is broadcast; a larger one is joined by shuffle (see ``operators.route``).
    ``scripts`` are the distinct forms of script; the numbers and names of a definition's own are in its row.
    """

    spark: SparkSession
    table: DataFrame
    size: int
    scripts: tuple[Script, ...]
    #: What the scripts read, in the order of the numbers that definitions give.
    inputs: tuple[tuple[Path, str], ...]
    slot_options: Mapping[str, tuple[int, ...]]
    dimension_names: tuple[str, ...]
    max_dimensions: int
    any_event: bool
    event_codes: tuple[str, ...] | None
    repeated_refs: bool
    fold_kinds: frozenset[str]
    small: bool
    #: Definitions that an order may match at most; 0 where they were not counted.
    fan_out: int = 0
    content: tuple = ()
    #: The normalised definitions that this was made from.
    source: DataFrame | None = None

    @classmethod
    def of(
        cls,
        definitions: DataFrame,
        broadcast_rows: int = BROADCAST_ROWS,
        broadcast_bytes: int = BROADCAST_BYTES,
    ) -> DefinitionSet:
        spark = definitions.sparkSession
        # One pass tells size, width and content, before anything is collected.
        types = F.to_json(F.transform(F.array_sort(F.map_entries("field_types")), lambda e: e))
        text = F.to_json(F.struct(*[c for c in definitions.columns if c != "field_types"], types.alias("types")))
        measured = definitions.agg(
            F.count("*"),
            F.coalesce(F.sum(F.octet_length(text)), F.lit(0)),
            F.sum(F.xxhash64(text).cast("decimal(38,0)")),
            F.sum(F.xxhash64(F.lit(1), text).cast("decimal(38,0)")),
        ).first()
        if measured[0] <= broadcast_rows and measured[1] <= broadcast_bytes:
            found = cls._held(spark, sorted(definitions.collect(), key=lambda r: r.def_ord))
        else:
            found = cls._stored(spark, definitions)
        return replace(found, content=tuple(measured), source=definitions)

    def with_table(self, table: DataFrame, **facts) -> DefinitionSet:
        """The same scripts and names for some of the definitions."""
        return replace(self, table=table, **facts)

    @classmethod
    def of_rows(cls, spark: SparkSession, rows: Iterable[Mapping]) -> DefinitionSet:
        return cls.of(definitions_from_rows(spark, rows))

    @classmethod
    def _held(cls, spark: SparkSession, rows: Sequence[T.Row]) -> DefinitionSet:
        first_of_ref: dict[str, int] = {}
        for number, row in enumerate(rows):
            first_of_ref.setdefault(row.ref_name, number)
        names = tuple(dict.fromkeys(d for row in rows for d in row.dimensions))
        codes = sorted({c for row in rows for c in row.event_type_codes if c is not None})
        scripts = _Scripts(spark)
        own = []
        for row in rows:
            types = dict(row.field_types)
            number, lifted = scripts.add(row.acc_script, types, scripts.lifted(row.acc_script, types))
            slots = scripts.slots(lifted.shape, lifted.names) if lifted else []
            own.append((number, list(lifted.numbers) if lifted else [], slots))
        folds: dict[str, set[str]] = {}
        for row, (number, _, _) in zip(rows, own):
            own_fold = {scripts.scripts[number].fold} if scripts.scripts[number].runs else set()
            folds.setdefault(row.ref_name, set()).update(own_fold)
        kinds = {name: _fold_of_name(found) for name, found in folds.items()}
        plain = spark.createDataFrame(
            [
                (number, first_of_ref[r.ref_name], *own[number], FOLDS.index(kinds[r.ref_name]), *r[1:7], r.acc_script)
                for number, r in enumerate(rows)
            ],
            "def_ord long, ref_ord long, script_id int, params array<double>, slots array<int>, fold int, ref_name string,"
            "event_type_codes array<string>, dimensions array<string>, slice_seconds long, window_slices int,"
            "slice_granularity string, acc_script string",
        ).coalesce(1)
        most = max((len(r.dimensions) for r in rows), default=0)
        any_event = sum(not r.event_type_codes for r in rows)
        typed = Counter(c for row in rows for c in set(row.event_type_codes))
        listed = codes if any_event * len(codes) <= BROADCAST_ROWS and len(codes) <= LISTED_CODES else None
        return cls(
            spark=spark,
            table=_routing_columns(plain, names, most, listed),
            size=len(rows),
            scripts=tuple(scripts.scripts),
            inputs=tuple(scripts.inputs),
            slot_options={slot: tuple(sorted(found)) for slot, found in scripts.options.items()},
            dimension_names=names,
            max_dimensions=most,
            any_event=any_event > 0,
            event_codes=None if listed is None else tuple(listed),
            repeated_refs=len(first_of_ref) < len(rows),
            fold_kinds=frozenset(kinds.values()),
            small=True,
            fan_out=any_event + max(typed.values(), default=0),
        )

    @classmethod
    def _stored(cls, spark: SparkSession, definitions: DataFrame) -> DefinitionSet:
        """A snapshot too large to hold: a stored table, with only its script forms and distinct names read here."""
        definitions = stored(definitions, SNAPSHOT)
        types = F.to_json(F.transform(F.array_sort(F.map_entries("field_types")), lambda e: e))
        keyed = definitions.withColumn("types_text", types)
        scripts = _Scripts(spark)
        distinct = keyed.select("acc_script", "types_text").distinct()
        lifted = stored(distinct.mapInPandas(partial(_lifted, keywords=scripts.keywords), _LIFTED), SNAPSHOT)
        forms = lifted.groupBy("form").agg(*[F.min_by(c, "acc_script").alias(c) for c in ("acc_script", "types_text")])
        ids = []
        for row in forms.collect():
            own = {e["key"]: e["value"] for e in json.loads(row.types_text)}
            ids.append((row.form, *scripts.add(row.acc_script, own, scripts.lifted(row.acc_script, own))))
        templates = spark.createDataFrame(
            [(form, n, part is not None) for form, n, part in ids], "form string, template_id int, is_template boolean"
        )
        placed = lifted.join(templates, "form")
        # forms that are no templates are checked one by one
        alone = [
            (r.acc_script, r.types_text, scripts.add(r.acc_script, {e["key"]: e["value"] for e in json.loads(r.types_text)}, None)[0])
            for r in placed.where("not is_template").select("acc_script", "types_text").collect()
        ]
        used = placed.where("is_template").select("template_id", F.explode("names").alias("n")).select("n.*").distinct()
        for row in used.orderBy("place", "name", "kind").collect():
            number = scripts.input(tuple(row.name.split(".")), row.kind)
            scripts.options.setdefault(name_slot(row.place, row.kind), set()).add(number)
        numbers = {(".".join(path), kind): n for (path, kind), n in scripts.inputs.items()}
        inputs = spark.createDataFrame([(*k, n) for k, n in numbers.items()], "name string, kind string, number int")
        slots = (
            placed.where("is_template")
            .select("acc_script", "types_text", F.explode("names").alias("n"))
            .join(F.broadcast(inputs), (F.col("n.name") == F.col("name")) & (F.col("n.kind") == F.col("kind")))
            .groupBy("acc_script", "types_text")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("n.place", "number"))), lambda s: s["number"]).alias("slots"))
        )
        single = spark.createDataFrame(alone, "acc_script string, types_text string, own_id int")
        identity = ["acc_script", "types_text"]
        numbered = placed.join(single, identity, "left").join(slots, identity, "left")
        numbered = numbered.select(
            *identity,
            F.coalesce("own_id", "template_id").alias("script_id"),
            F.when(F.col("is_template"), F.col("params")).otherwise(F.array().cast("array<double>")).alias("params"),
            F.coalesce("slots", F.array().cast("array<int>")).alias("slots"),
        )
        kinds = spark.createDataFrame([(n, s.fold if s.runs else None) for n, s in enumerate(scripts.scripts)], "script_id int, own_fold string")
        plain = keyed.join(numbered, identity).join(F.broadcast(kinds), "script_id")
        ordered, general = (F.lit(FOLDS.index(k)) for k in ("ordered", "general"))
        code = F.array_position(F.array(*map(F.lit, FOLDS)), F.min("own_fold")).cast("int") - 1
        mixed = F.when(F.max((F.col("own_fold") == "ordered").cast("int")) == 1, ordered).otherwise(general)
        refs = plain.groupBy("ref_name").agg(
            F.min("def_ord").alias("ref_ord"),
            F.when(F.min("own_fold") == F.max("own_fold"), code)
            .when(F.min("own_fold").isNull(), F.lit(FOLDS.index("last")))
            .otherwise(mixed)
            .alias("fold"),
        )
        plain = plain.join(refs, "ref_name")
        names = tuple(sorted(r[0] for r in definitions.select(F.explode("dimensions")).distinct().collect()))
        facts = definitions.agg(
            F.count("*"),
            F.max(F.size("dimensions")),
            F.max((F.size("event_type_codes") == 0).cast("int")),
        ).first()
        plain = stored(plain, SNAPSHOT)
        return cls(
            spark=spark,
            table=_routing_columns(plain, names, facts[1], None),
            size=facts[0],
            scripts=tuple(scripts.scripts),
            inputs=tuple(scripts.inputs),
            slot_options={slot: tuple(sorted(found)) for slot, found in scripts.options.items()},
            dimension_names=names,
            max_dimensions=facts[1],
            any_event=bool(facts[2]),
            event_codes=None,
            repeated_refs=True,
            fold_kinds=frozenset(FOLDS[r[0]] for r in plain.select("fold").distinct().collect()),
            small=False,
        )

    @cached_property
    def reads_current(self) -> bool:
        return any((CURRENT,) in s.inputs for s in self.scripts)

    @cached_property
    def input_names(self) -> tuple[str, ...]:
        """Fields the scripts read.  An order field called ``current`` hides the slice value."""
        return tuple(sorted({path[0] for path, _ in self.inputs}))

    def same_as(self, other: DefinitionSet) -> bool:
        """The same definitions in the same order, whatever their number."""
        return self.content == other.content


def _fold_of_name(folds: set[str]) -> str:
    """How an indicator's running value is made; mixed kinds need the general way."""
    if len(folds) < 2:
        return next(iter(folds), "last")
    return "ordered" if "ordered" in folds else "general"


_LIFTED = (
    "acc_script string, types_text string, form string, params array<double>,"
    " names array<struct<place: int, name: string, kind: string>>"
)


def _lifted(parts: Iterator[pd.DataFrame], keywords: frozenset[str]) -> Iterator[pd.DataFrame]:
    """The form of each distinct script, and what is lifted out of it; a script without a form is one of its own."""
    for part in parts:
        rows = []
        for text, types_text in zip(part["acc_script"], part["types_text"], strict=True):
            found = lift(text, {e["key"]: e["value"] for e in json.loads(types_text)}, keywords)
            if found is None:
                rows.append((text, types_text, json.dumps([text, types_text]), [], []))
                continue
            names = [(i, ".".join(path), kind) for i, (path, kind) in enumerate(zip(found.names, found.shape.kinds, strict=True))]
            form = json.dumps([found.shape.text, found.shape.fractions, found.shape.kinds])
            rows.append((text, types_text, form, list(found.numbers), names))
        yield pd.DataFrame(rows, columns=["acc_script", "types_text", "form", "params", "names"])


def _routing_columns(plain: DataFrame, names: Sequence[str], most: int, codes: Sequence[str] | None) -> DataFrame:
    """One row per definition: its route keys, and its dimensions as numbered columns.

    A definition without event types is routed by ``*``, and by every code when these are given.
    """
    number_of = F.create_map(*[F.lit(x) for n, name in enumerate(names) for x in (name, n)]) if names else None
    dimension_columns = []
    for i in range(most):
        name = F.try_element_at("dimensions", F.lit(i + 1))
        dimension_columns.append(F.try_element_at(number_of, name).alias(f"dim_{i}"))
        dimension_columns.append(F.concat(name, F.lit("#")).alias(f"label_{i}"))
    typed = F.transform(F.array_distinct("event_type_codes"), lambda c: F.concat(F.lit("="), c))
    every = F.array(F.lit("*"), *[F.lit(f"={c}") for c in codes or ()])
    keys = F.when(F.size("event_type_codes") <= 0, every).otherwise(typed)
    return plain.select(
        "def_ord",
        "ref_ord",
        "script_id",
        "params",
        "slots",
        "fold",
        "ref_name",
        "slice_seconds",
        "window_slices",
        "slice_granularity",
        "acc_script",
        F.size("dimensions").alias("n_dims"),
        *dimension_columns,
        keys.alias("route_keys"),
    )


# ---------------------------------------------------------------- refresh


class DefinitionFeed:
    """Keeps the latest good snapshot.

    It starts with the built-in definitions.  A load that fails or finds nothing leaves
    the snapshot as it is; a failed one is kept as a refusal until somebody takes it.
    """

    MIN_REFRESH_SECONDS = 5.0

    def __init__(self, spark: SparkSession, load: Callable[[], DataFrame], refresh_seconds: float = 30.0):
        self._load = load
        self.refresh_seconds = max(self.MIN_REFRESH_SECONDS, refresh_seconds)
        self.snapshot = DefinitionSet.of_rows(spark, BOOTSTRAP)
        self.last_error: str | None = None
        self._refusals: list[tuple[float, str]] = []

    def refresh(self) -> bool:
        """Load once; True when the snapshot changed."""
        try:
            fresh = DefinitionSet.of(self._load())
        except Exception as error:  # any failed load leaves the snapshot in place
            self.last_error = str(error)
            # the same refusal over and over is one
            text = f"{REFUSED}{self.last_error.splitlines()[0] if self.last_error else type(error).__name__}"
            if not self._refusals or self._refusals[-1][1] != text:
                self._refusals.append((time.time(), text))
            log.warning("definitions were not refreshed: %s", error)
            return False
        self.last_error = None
        if fresh.size == 0 or fresh.same_as(self.snapshot):
            return False
        self.snapshot = fresh
        return True

    def take_refusals(self) -> list[tuple[float, str]]:
        """(time, reason) of refused loads since this was last asked."""
        taken, self._refusals = self._refusals, []
        return taken
