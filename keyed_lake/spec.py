"""Table specs: the declarative description every job is driven by."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from xml.etree import ElementTree

from pyspark.sql import SparkSession
from pyspark.sql import types as T

PARTITION_COLUMN = "pt_date"
RESERVED_PREFIX = "_"  # names the engine gives to columns and folders of its own

# The type names a spec may use.
TYPE_NAMES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "STR": T.StringType(),
    "BINARY": T.BinaryType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIME": T.TimestampType(),
    "DECIMAL": T.DecimalType(10, 0),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.FloatType(),
    "BYTE": T.ByteType(),
    "INTEGER": T.IntegerType(),
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "SHORT": T.ShortType(),
}
# Short names that have no long form ending in TYPE.
SHORT_ONLY = {"STR", "TIME", "INT"}
# Names that parse but cannot hold data, so a spec must not use them.
UNUSABLE_TYPES = {"NULL", "NULLTYPE", "DATA", "DATATYPE"}


def parse_type(name: str) -> T.DataType:
    """Map a type name of a spec to a Spark type. `decimal(p,s)` is accepted besides the plain names."""
    text = name.strip().upper()
    if text in UNUSABLE_TYPES:
        raise ValueError(f"type {name!r} holds no data and can't be a column type")
    short = text.removesuffix("TYPE")
    if short in TYPE_NAMES and (short == text or short not in SHORT_ONLY):
        return TYPE_NAMES[short]
    if text.startswith("DECIMAL(") and text.endswith(")"):
        precision, _, scale = text[len("DECIMAL(") : -1].partition(",")
        return T.DecimalType(int(precision), int(scale or 0))
    raise ValueError(f"unsupported type: {name}")


@dataclass(frozen=True)
class TableSpec:
    """One table: its columns, keys, order and where its CSV files, log and table live."""

    name: str
    columns: tuple[str, ...]
    pks: tuple[str, ...]
    order_by: tuple[str, ...]
    types: tuple[T.DataType, ...] = ()
    partition_by: str | None = None
    csv_folder: str = ""
    topic: str = ""
    table_folder: str = ""
    partitions: int = 10
    compact: bool = True
    processing_time: int = 5
    max_offsets_per_trigger: int = 5_000_000
    _by_name: dict[str, T.DataType] = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        def clean(names: Iterable[str]) -> tuple[str, ...]:
            return tuple(n.strip().lower() for n in names if n.strip())

        put = lambda name, value: object.__setattr__(self, name, value)
        put("columns", clean(self.columns))
        put("pks", clean(self.pks))
        put("order_by", clean(self.order_by))
        put("types", tuple(self.types) or (T.StringType(),) * len(self.columns))
        if self.partition_by is not None:
            put("partition_by", self.partition_by.strip().lower() or None)

        if not self.columns:
            self._fail("columns are required")
        if len(set(self.columns)) != len(self.columns):
            self._fail(f"duplicate columns in {self.columns}")
        if len(self.types) != len(self.columns):
            self._fail(f"{len(self.types)} types for {len(self.columns)} columns")
        put("_by_name", dict(zip(self.columns, self.types)))
        if not self.pks:
            self._fail("pks can't be empty")
        if not self.order_by:
            self._fail("orderBy is required")
        for role, names in (("pk", self.pks), ("orderBy", self.order_by)):
            for name in names:
                if name not in self._by_name:
                    self._fail(f"{role} column {name} is not in columns {self.columns}")
        for name in self.columns:
            if name == PARTITION_COLUMN or name.startswith(RESERVED_PREFIX):
                self._fail(f"column name {name} is reserved")
        if self.partition_by is not None:
            if self.partition_by not in self._by_name:
                self._fail(f"partitionBy column {self.partition_by} is not in columns {self.columns}")
            if not isinstance(self._by_name[self.partition_by], T.TimestampType):
                self._fail(f"partitionBy column {self.partition_by} must be a timestamp")
        for role, number in (
            ("partitions", self.partitions),
            ("maxOffsetsPerTrigger", self.max_offsets_per_trigger),
        ):
            if number < 1:
                self._fail(f"{role} must be at least 1")

    def _fail(self, message: str):
        raise ValueError(f"[{self.name}] {message}")

    def type_of(self, column: str) -> T.DataType:
        return self._by_name[column]

    @property
    def partition_column(self) -> str | None:
        return PARTITION_COLUMN if self.partition_by else None

    @property
    def row_schema(self) -> T.StructType:
        """The declared columns, all nullable."""
        return T.StructType([T.StructField(c, t, True) for c, t in zip(self.columns, self.types)])

    @property
    def table_schema(self) -> T.StructType:
        """The declared columns plus the derived date when the table is partitioned."""
        fields = list(self.row_schema.fields)
        if self.partition_column:
            fields.append(T.StructField(self.partition_column, T.DateType(), True))
        return T.StructType(fields)

    @property
    def text_schema(self) -> T.StructType:
        """The declared columns as text, as they stand in a header-less CSV file."""
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])

    @property
    def table_columns(self) -> list[str]:
        return self.table_schema.fieldNames()


def _flag(name: str, text: str) -> bool:
    value = text.strip().lower()
    if value not in ("true", "false"):
        raise ValueError(f"[{name}] compact must be true or false, not {text!r}")
    return value == "true"


def parse_specs(xml_text: str | bytes) -> dict[str, TableSpec]:
    """Read all table specs of one XML document, by table name."""
    specs: dict[str, TableSpec] = {}
    for node in ElementTree.fromstring(xml_text):
        name = node.get("name")
        if not name:
            raise ValueError("every table needs a name")
        if name in specs:
            raise ValueError(f"duplicate name: {name}")
        found = {child.tag: (child.text or "").strip() for child in node}
        for tag in ("columns", "pks", "orderBy", "csvFolder", "topic", "deltaFolder"):
            if not found.get(tag):
                raise ValueError(f"[{name}] {tag} is required")
        types = found.get("types")
        specs[name] = TableSpec(
            name=name,
            columns=found["columns"].split(","),
            pks=found["pks"].split(","),
            order_by=found["orderBy"].split(","),
            types=[parse_type(t) for t in types.split(",")] if types else (),
            partition_by=found.get("partitionBy") or None,
            csv_folder=found["csvFolder"],
            topic=found["topic"],
            table_folder=found["deltaFolder"],
            partitions=int(found.get("partitions") or 10),
            compact=_flag(name, found.get("compact") or "true"),
            processing_time=int(found.get("processingTime") or 5),
            max_offsets_per_trigger=int(found.get("maxOffsetsPerTrigger") or 5_000_000),
        )
    return specs


def load_specs(spark: SparkSession, path: str) -> dict[str, TableSpec]:
    """Read a spec file from any file system Spark can reach. The file is kilobytes of configuration."""
    return parse_specs(spark.read.text(path, wholetext=True).head()[0])
