"""Schedules: one raw table per code and kind, unified, typed, merged and filled."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from strata.functions.names import col, layer_db, qualified, split_technical
from strata.operators.layers import create_database, write_table
from strata.operators.merge import merge_pairs
from strata.operators.nullfill import null_fill
from strata.operators.typed_union import union_typed
from strata.operators.typing_text import LostCells
from strata.operators.union import (
    CODE_COLUMN,
    SOURCE_COLUMN,
    discover_codes,
    find_relations,
    source_code,
)
from strata.session import WRITERS, in_parallel

log = logging.getLogger(__name__)

SUBJECT = "cronogramas"


@dataclass(frozen=True)
class Kind:
    """One purpose of schedule tables."""

    suffix: str
    table: str
    force_numeric: list[str] = field(default_factory=list)
    merges: list[tuple[str, str, str]] = field(default_factory=list)

    @property
    def pattern(self) -> str:
        return "mk%" + self.suffix


# Table suffixes and names, money columns that may hold nothing
# but a placeholder, and the column pairs of which one or the other is filled.
BANK = Kind("_00___BANCO", "fct_banco")
ACTIVITIES = Kind("_00___ATIVIDADES", "fct_atividades")
DELIVERIES = Kind(
    "_00___ENTREGAS",
    "fct_entregas",
    force_numeric=["FAT__PRODUTO", "FAT__PESSOAL_PRD_"],
    merges=[
        ("_COMISSAO_", "COMISSAO", "COMISSAO"),
        ("_FAT__PRODUTO_", "FAT__PRODUTO", "FAT. PRODUTO"),
        ("_FAT__SERVICO_", "FAT__SERVICO", "FAT. SERVICO"),
        ("FAT__PESSOAL_PRD_", "_FAT__PESSOAL_PRD__", "FAT. PESSOAL PRD."),
        ("FAT__PESSOAL_SERV_", "_FAT__PESSOAL_SERV__", "FAT. PESSOAL SERV."),
    ],
)
KINDS = [BANK, ACTIVITIES, DELIVERIES]


def staging(
    spark: SparkSession,
    relations: list[tuple[str, DataFrame]],
    force_numeric: list[str] | None = None,
    merges: list[tuple[str, str, str]] | None = None,
    lost: LostCells | None = None,
) -> DataFrame:
    """Union of the relations with code and origin in front and typed columns behind.

    Every relation is read in its own number form. Columns to force that no relation has are
    named in a warning. A column without any value is numeric if the one it is to be merged with
    is. ``lost`` counts the cells that typing lets go when the result is written.
    """
    present = {n for _, df in relations for n in df.columns}
    forced = [n for n in force_numeric or [] if n in present]
    if relations and (absent := sorted(set(force_numeric or []) - set(forced))):
        log.warning("no columns %s in %s", ", ".join(absent), ", ".join(name for name, _ in relations))
    pairs = [(first, second) for first, second, _ in merges or []]
    typed = union_typed(spark, relations, force_numeric=forced, partners=pairs, lost=lost)
    technical, business = split_technical([n for n in typed.columns if n != SOURCE_COLUMN])
    return typed.select(
        source_code(col(SOURCE_COLUMN)).alias(CODE_COLUMN),
        *[col(n) for n in [SOURCE_COLUMN, *technical, *business]],
    )


def intermediate(
    stg: DataFrame, merges: list[tuple[str, str, str]] | None = None, strict: bool = True
) -> DataFrame:
    """Merged column pairs; without pairs, the staging rows as they are.

    With no source table at all there is nothing to merge.
    """
    if not merges or stg.columns == [CODE_COLUMN, SOURCE_COLUMN]:
        return stg
    return merge_pairs(stg, merges, strict)


def mart(intermediate_df: DataFrame) -> DataFrame:
    return null_fill(intermediate_df)


def run(
    spark: SparkSession,
    raw_db: str | None = None,
    codes: list[str] | None = None,
    kinds: list[Kind] | None = None,
    subject: str = SUBJECT,
    strict: bool = True,
    threads: int = WRITERS,
) -> dict[str, DataFrame]:
    """Rebuild staging, intermediate and mart of all kinds; returns the mart tables.

    Without ``codes``, all codes found in the raw database are taken.
    """
    kinds = KINDS if kinds is None else kinds
    raw_db = raw_db or layer_db("raw", subject)
    if codes is None:
        codes = discover_codes(spark, raw_db, [k.pattern for k in kinds])
    stg_db, int_db, mart_db = [
        create_database(spark, layer_db(layer, subject)) for layer in ("stg", "int", "mart")
    ]

    def rebuild(kind: Kind) -> DataFrame:
        relations = find_relations(spark, raw_db, codes, kind.suffix)
        lost = LostCells()
        write_table(staging(spark, relations, kind.force_numeric, kind.merges, lost), stg_db, kind.table)
        for column, n in lost.counts().items():
            if n:
                log.warning("%s.%s: %d cells of %s are no numbers and became NULL", stg_db, kind.table, n, column)
        stg = spark.table(qualified(stg_db, kind.table))
        write_table(intermediate(stg, kind.merges, strict), int_db, kind.table)
        write_table(mart(spark.table(qualified(int_db, kind.table))), mart_db, kind.table)
        return spark.table(qualified(mart_db, kind.table))

    return dict(zip([k.table for k in kinds], in_parallel(spark, rebuild, kinds, threads)))
