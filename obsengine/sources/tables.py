"""Landing relational tables as Parquet, and reading them back."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The source tables.
TABLES = (
    "comuni",
    "comuni_usl",
    "comuni_zone",
    "province",
    "rqa_configurazioni",
    "rqa_dati_aria_cor",
    "rqa_elementi",
    "rqa_enti",
    "rqa_metodi",
    "rqa_parametri",
    "rqa_t_frequenze",
    "rqa_t_reti",
    "rqa_t_stclass_eu",
    "rqa_t_zona",
    "rqa_ubicazioni",
    "t_unita_misura",
    "v_rqa_rete_regionale_ipr",
)


# Fixed value: the table of measurements, which is too large for a single read.
LARGE_TABLES = ("rqa_dati_aria_cor",)

# Rows a database driver hands over at a time; some keep the whole result without it.
FETCH_SIZE = 10_000


@dataclass(frozen=True)
class Split:
    """How to read one table in parallel: a column, its bounds and the number of reads."""

    column: str
    lower: str
    upper: str
    reads: int


@dataclass(frozen=True)
class HashSplit:
    """A table read in ``reads`` parts by a hash of a column, even where its values are not, and
    its NULL keys in a part of their own.

    ``hashed`` is the database's expression of a whole number from 0 to ``reads`` - 1 for a known key;
    the default is PostgreSQL's.
    """

    column: str
    reads: int
    hashed: str = "mod(mod(hashtext(cast({column} as text))::bigint, {reads}) + {reads}, {reads})"

    def predicates(self) -> list[str]:
        name = _quoted(self.column)
        part = self.hashed.format(column=name, reads=self.reads)
        known = [f"{name} is not null and {part} = {i}" for i in range(self.reads)]
        return [*known, f"{name} is null"]


@dataclass(frozen=True)
class RangeSplit:
    """A table read in ranges of a column between sorted ``cuts`` (SQL literals), and its NULLs.

    ``cuts_query`` asks the database for cuts that leave equally many rows in every range.
    """

    column: str
    cuts: Sequence[str]

    def predicates(self) -> list[str]:
        name = _quoted(self.column)
        cuts = list(dict.fromkeys(self.cuts))
        if not cuts:
            return [f"{name} is not null", f"{name} is null"]
        inner = [f"{name} >= {a} and {name} < {b}" for a, b in zip(cuts, cuts[1:])]
        return [f"{name} < {cuts[0]}", *inner, f"{name} >= {cuts[-1]}", f"{name} is null"]


def cuts_query(schema: str, table: str, column: str, reads: int) -> str:
    """PostgreSQL's query for the cuts of a ``RangeSplit`` of ``reads`` ranges, one a row, in order.

    Equal cuts, which a frequent value gives, come once.
    """
    shares = ", ".join(str(round(i / reads, 9)) for i in range(1, reads))
    name = _quoted(column)
    return (
        f"select distinct unnest(percentile_disc(array[{shares}]) within group (order by {name})) as cut"
        f' from "{schema}"."{table}" order by cut'
    )


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@dataclass(frozen=True)
class JdbcSource:
    """Whole tables of one database schema; names are quoted, so their case counts.

    Tables named in ``large`` are only read with a split: even steps between two bounds
    (``Split``), a hash of the key (``HashSplit``) or ranges of equal counts (``RangeSplit``).
    """

    url: str
    schema: str
    properties: dict[str, str] = field(default_factory=dict)
    splits: dict[str, Split | HashSplit | RangeSplit] = field(default_factory=dict)
    large: Sequence[str] = LARGE_TABLES

    def options(self, table: str) -> dict[str, str]:
        split = self.splits.get(table)
        if split is None and table in self.large:
            raise ValueError(f"{table} is large: give a Split, so that it is read in parallel")
        options = {
            "fetchsize": str(FETCH_SIZE),
            **self.properties,
            "url": self.url,
            "dbtable": f'"{self.schema}"."{table}"',
        }
        if isinstance(split, Split):
            options |= {
                "partitionColumn": split.column,
                "lowerBound": split.lower,
                "upperBound": split.upper,
                "numPartitions": str(split.reads),
            }
        return options

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        options = self.options(table)
        split = self.splits.get(table)
        if isinstance(split, HashSplit | RangeSplit):
            url, name = options.pop("url"), options.pop("dbtable")
            return spark.read.jdbc(url, name, predicates=split.predicates(), properties=options)
        return spark.read.format("jdbc").options(**options).load()


def table_path(base: str, table: str) -> str:
    return f"{base}/{table}/{table}.parquet"


def ingest_tables(
    read: Callable[[str], DataFrame], base: str, tables: Sequence[str] = TABLES
) -> dict[str, str]:
    """Write each table to its own path, never over an existing one.  Returns the paths."""
    paths = {table: table_path(base, table) for table in tables}
    for table, path in paths.items():
        read(table).write.mode("errorifexists").parquet(path)
    return paths


def load_tables(
    spark: SparkSession, base: str, tables: Sequence[str] = TABLES
) -> dict[str, DataFrame]:
    """The landed tables by name."""
    return {table: spark.read.parquet(table_path(base, table)) for table in tables}
