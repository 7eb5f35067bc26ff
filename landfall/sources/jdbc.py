"""Database sources through Spark's JDBC reader: S1-S6, S15, A2."""

from __future__ import annotations

import math
from collections.abc import Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import QualifiedName, quote_identifier
from ..operators.conform import STAND_IN_TYPE, UNSUPPORTED_TYPES

# Fixed value: rows per round trip.
FETCH_SIZE = 10_000

_INFORMATION_TABLES = (
    "SELECT table_schema AS schema_name, table_name AS table_name FROM information_schema.tables"
)
_INFORMATION_COLUMNS = (
    "SELECT table_schema AS schema_name, table_name AS table_name, column_name AS column_name,"
    " data_type AS data_type, ordinal_position AS position FROM information_schema.columns"
)


@dataclass(frozen=True)
class Dialect:
    """What differs between databases: the catalog queries, numbered rows and the quotes."""

    tables: str = _INFORMATION_TABLES
    columns: str = _INFORMATION_COLUMNS
    # The rows of a relation with their place in an order, as column "place".
    numbered: str = (
        "SELECT {columns}, ROW_NUMBER() OVER (ORDER BY {columns}) AS place FROM {table} WHERE {known}"
    )
    left: str = '"'
    right: str = '"'

    def quote(self, name: str) -> str:
        return quote_identifier(name, self.left, self.right)


DIALECTS = {
    "postgresql": Dialect(),
    "sqlserver": Dialect(left="[", right="]"),
    "derby": Dialect(
        tables=(
            "SELECT s.schemaname AS schema_name, t.tablename AS table_name"
            " FROM sys.systables t JOIN sys.sysschemas s ON t.schemaid = s.schemaid"
        ),
        columns=(
            "SELECT s.schemaname AS schema_name, t.tablename AS table_name,"
            " c.columnname AS column_name, CAST(c.columndatatype AS VARCHAR(128)) AS data_type,"
            " c.columnnumber AS position"
            " FROM sys.syscolumns c JOIN sys.systables t ON c.referenceid = t.tableid"
            " JOIN sys.sysschemas s ON t.schemaid = s.schemaid"
        ),
        numbered=(
            "SELECT {columns}, ROW_NUMBER() OVER () AS place FROM"
            " (SELECT {columns} FROM {table} WHERE {known} ORDER BY {columns}) ordered"
        ),
    ),
}


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def constant(value: object) -> str:
    """A value as SQL compares a column with it; dates and times go as quoted text."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int | float | Decimal):
        return str(value)
    return literal(str(value))


@dataclass(frozen=True)
class Database:
    """A connection, as options for Spark's reader."""

    url: str
    options: Mapping[str, str] = field(default_factory=dict)
    fetch_size: int = FETCH_SIZE

    @property
    def dialect(self) -> Dialect:
        return DIALECTS.get(self.url.split(":")[1], Dialect())

    def query(self, spark: SparkSession, sql: str) -> DataFrame:
        """Result of a query the database runs, in one task."""
        return self._reader(spark).option("query", sql).load()

    def _reader(self, spark: SparkSession):
        return (
            spark.read.format("jdbc")
            .option("url", self.url)
            .option("fetchsize", self.fetch_size)
            .options(**self.options)
        )

    def tables(self, spark: SparkSession, schema: str, *, any_case: bool = False) -> DataFrame:
        """Tables and views of one schema: column ``table_name`` (S3)."""
        schema_of = F.lower("schema_name") if any_case else F.col("schema_name")
        wanted = schema.lower() if any_case else schema
        listed = self._catalog(spark, self.dialect.tables)
        return listed.filter(schema_of == wanted).select("table_name")

    def columns(self, spark: SparkSession, name: QualifiedName) -> DataFrame:
        """Columns of one table in order: ``column_name``, ``data_type``."""
        listed = self._catalog(spark, self.dialect.columns)
        return (
            listed.filter((F.col("schema_name") == name.schema) & (F.col("table_name") == name.table))
            .select("column_name", "data_type", "position")
            .orderBy("position")
            .drop("position")
        )

    def _catalog(self, spark: SparkSession, sql: str) -> DataFrame:
        """A catalog query as a relation, so that filters reach the database."""
        listed = self._reader(spark).option("dbtable", f"({sql}) listed").load()
        return listed.toDF(*(c.lower() for c in listed.columns))

    def count(self, spark: SparkSession, name: QualifiedName) -> int:
        """Row count, taken by the database."""
        sql = f"SELECT COUNT(*) AS total FROM {self._quoted(name)}"
        return int(self.query(spark, sql).first()[0])

    def _quoted(self, name: QualifiedName) -> str:
        return name.quote(self.dialect.left, self.dialect.right)


@dataclass(frozen=True)
class Split:
    """How a table scan is cut into parallel reads.

    By ranges of a number, date or timestamp column, with bounds taken from
    the database if not given; or, where values pile up, by ``predicates`` that
    together cover each row once.

    With ``equal_depth`` the database is asked for the values that cut its rows into parts
    of as many rows each, whatever their distribution; it sorts the column for that, so
    an index on it helps. Rows of one value are in one part, unless a ``tie`` column
    cuts them further. NULLs are in parts of their own.
    """

    column: str | None = None
    partitions: int = 1
    lower: str | None = None
    upper: str | None = None
    predicates: Sequence[str] = ()
    equal_depth: bool = False
    tie: str | None = None

    def __post_init__(self):
        if self.equal_depth and not self.column:
            raise ValueError("parts of equal depth need a column")
        if self.tie and not self.equal_depth:
            raise ValueError("a tie column goes with equal_depth")


@dataclass(frozen=True)
class JdbcTable:
    """A database table as the source of a load."""

    database: Database
    name: QualifiedName
    split: Split = Split()
    # None reads all columns; see ``typed_projection``.
    projection: str | None = None

    # Another read may see another state, so a load reads it once.
    repeatable = False

    @property
    def relation(self) -> str:
        table = self.database._quoted(self.name)
        return f"(SELECT {self.projection} FROM {table}) picked" if self.projection else table

    def scan(self, spark: SparkSession) -> DataFrame:
        """The table as a frame; Catalyst sends filters and columns down."""
        split = self.split
        predicates = list(split.predicates)
        if split.equal_depth and split.partitions > 1 and not predicates:
            predicates = self._parts(spark)
        if predicates:
            return spark.read.jdbc(
                self.database.url,
                self.relation,
                predicates=predicates,
                properties={"fetchsize": str(self.database.fetch_size), **self.database.options},
            )
        reader = self.database._reader(spark).option("dbtable", self.relation)
        if split.column and split.partitions > 1 and not split.equal_depth:
            lower, upper = split.lower, split.upper
            if lower is None or upper is None:
                lower, upper = self._bounds(spark)
            if lower is not None:
                reader = reader.options(
                    partitionColumn=split.column,
                    lowerBound=str(lower),
                    upperBound=str(upper),
                    numPartitions=str(split.partitions),
                )
        return reader.load()

    def _bounds(self, spark: SparkSession) -> tuple:
        """Least and greatest value of the split column; Spark takes whole numbers only."""
        column = self.database.dialect.quote(self.split.column)
        low, high = self.database.query(
            spark,
            f"SELECT MIN({column}) AS low, MAX({column}) AS high"
            f" FROM {self.database._quoted(self.name)}",
        ).first()
        if isinstance(low, (float, Decimal)):
            low, high = math.floor(low), math.ceil(high)
        return low, high

    def _cuts(self, spark: SparkSession, names: Sequence[str], known: str) -> list[tuple]:
        """Values of the columns at every n-th of the rows where they are known, in order."""
        database, parts = self.database, self.split.partitions
        table = database._quoted(self.name)
        total = database.query(spark, f"SELECT COUNT(*) AS total FROM {table} WHERE {known}").first()[0]
        places = sorted({int(total) * part // parts + 1 for part in range(1, parts)})
        if int(total) < 2:
            return []
        numbered = database.dialect.numbered.format(
            columns=", ".join(names), table=table, known=known
        )
        wanted = ", ".join(map(str, places))
        sql = f"SELECT {', '.join(names)}, place FROM ({numbered}) numbered WHERE place IN ({wanted})"
        found = sorted(database.query(spark, sql).collect(), key=lambda row: row[-1])
        return list(dict.fromkeys(tuple(row)[:-1] for row in found))

    def _parts(self, spark: SparkSession) -> list[str]:
        """Predicates of parts between the cuts; each row, NULLs included, is in one of them."""
        split, quote = self.split, self.database.dialect.quote
        names = [quote(name) for name in (split.column, split.tie) if name]
        known = " AND ".join(f"{name} IS NOT NULL" for name in names)
        unknown = [f"{names[0]} IS NULL"]
        if split.tie:
            unknown.append(f"{names[0]} IS NOT NULL AND {names[1]} IS NULL")

        def before(cut: tuple) -> str:
            first = f"{names[0]} < {constant(cut[0])}"
            if len(cut) == 1:
                return first
            return f"({first} OR ({names[0]} = {constant(cut[0])} AND {names[1]} < {constant(cut[1])}))"

        cuts, parts = self._cuts(spark, names, known), []
        for low, high in zip([None, *cuts], [*cuts, None], strict=True):
            inside = [known]
            inside += [f"NOT {before(low)}"] if low else []
            inside += [before(high)] if high else []
            parts.append(" AND ".join(inside))
        return parts + unknown

    def count(self, spark: SparkSession) -> int:
        return self.database.count(spark, self.name)

    def typed(
        self,
        spark: SparkSession,
        unsupported: Collection[str] = UNSUPPORTED_TYPES,
        *,
        keep_text: bool = False,
    ) -> JdbcTable:
        """The same table without the types Spark cannot read."""
        columns = [tuple(row) for row in self.database.columns(spark, self.name).collect()]
        if not columns:
            raise LookupError(f"no columns found for {self.name}")
        text = typed_projection(
            columns, self.database.dialect, unsupported, keep_text=keep_text
        )
        return replace(self, projection=text)


def typed_projection(
    columns: Iterable[tuple[str, str]],
    dialect: Dialect,
    unsupported: Collection[str] = UNSUPPORTED_TYPES,
    *,
    keep_text: bool = False,
) -> str:
    """``SELECT`` list with stand-ins for columns of unsupported types."""

    def item(name: str, kind: str) -> str:
        quoted = dialect.quote(name)
        if kind.lower() not in unsupported:
            return quoted
        return f"CAST({quoted if keep_text else 'NULL'} AS {STAND_IN_TYPE}) AS {quoted}"

    return ", ".join(item(name, kind) for name, kind in columns)
