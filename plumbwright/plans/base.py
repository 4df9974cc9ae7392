"""Registry of queries and the table access they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from plumbwright.functions.fixed import LOG_LINE, PARAGRAPH_BREAK, WHITESPACE
from plumbwright.plans.views import VIEWS, base_tables
from plumbwright.sources.tables import read_table


# Files that one micro-batch of a table stream reads.
FILES_PER_BATCH = 256


@dataclass(frozen=True)
class Tables:
    """The tables of one folder, and the dirty views defined over them."""

    spark: SparkSession
    folder: str

    def __getitem__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            return read_table(self.spark, self.folder, name)
        text = VIEWS[name]
        return self.spark.sql(text, **{t: self[t] for t in base_tables(text)})

    def stream(self, name: str) -> DataFrame:
        """A base table as a file stream."""
        schema = read_table(self.spark, self.folder, name).schema
        # Written as a pattern because a stream takes no plain path to a single file.
        # A long backlog becomes several micro-batches instead of one.
        reader = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH)
        return reader.parquet(f"{self.folder}/{name}.[p]arquet")

    def stream_view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        return self.spark.sql(text, **{t: self.stream(t) for t in base_tables(text)})


@dataclass(frozen=True)
class Plan:
    build: Callable[[Tables], DataFrame]
    oracle: str | None


PLANS: dict[str, Plan] = {}


def plan(name: str, oracle: str | None = None):
    """Register a query under a name together with its SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in PLANS:
            raise ValueError(f"query {name} is registered twice")
        PLANS[name] = Plan(build, oracle)
        return build

    return register


def sql(select: str, views: tuple[str, ...] = (), **ctes: str) -> str:
    """Assemble SQL text: the named dirty views, then further CTEs, then the SELECT."""
    parts = [f"{v} AS ({VIEWS[v].format(**{t: t for t in base_tables(VIEWS[v])})})" for v in views]
    parts += [f"{name} AS ({body})" for name, body in ctes.items()]
    head = f"WITH {', '.join(parts)} " if parts else ""
    return head + select


# SQL spellings of the cell rules, for the oracle texts.
WS = "'" + WHITESPACE + "'"
# The whitespace alphabet as an RE2 class, which knows no Unicode flag.
WS_CLASS = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
GAP = f"'[{WS_CLASS}]+'"
LOG_REGEX = "^" + LOG_LINE.replace("{ws}", WS_CLASS)
PARAGRAPH_REGEX = PARAGRAPH_BREAK.replace("{ws}", WS_CLASS)


# Number cells, spelled independently of the expressions under test.
_RUN = "[0-9](?:_?[0-9])*"
INT_CELL = f"[+-]?{_RUN}"
FLOAT_CELL = rf"[+-]?(?:(?:{_RUN}(?:\.(?:{_RUN})?)?|\.{_RUN})(?:[eE][+-]?{_RUN})?|(?i:inf|infinity|nan))"


def s_strip(c: str) -> str:
    return f"trim({c}, {WS})"


def s_norm(c: str) -> str:
    return f"coalesce({s_strip(c)}, '')"


def s_float(c: str) -> str:
    s = s_strip(c)
    return f"CASE WHEN regexp_full_match({s}, '{FLOAT_CELL}') THEN try_cast(replace({s}, '_', '') AS double) END"


def s_int(c: str) -> str:
    s = s_strip(c)
    return f"CASE WHEN regexp_full_match({s}, '{INT_CELL}') THEN try_cast(replace({s}, '_', '') AS bigint) END"


def s_long_int(c: str) -> str:
    """Whole numbers of up to 38 digits."""
    s = s_strip(c)
    return f"CASE WHEN regexp_full_match({s}, '{INT_CELL}') THEN try_cast(replace({s}, '_', '') AS decimal(38,0)) END"


def s_is_whole(c: str) -> str:
    return f"coalesce(regexp_full_match({s_strip(c)}, '{INT_CELL}'), false)"
