"""The gold table: one row per body, and the view over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripledger.operators.rollup import summary_over_children
from tripledger.schemas import GOLD_TABLE, GOLD_VIEW
from tripledger.sources.tables import current_versions, publish, table_name, write_version
from tripledger.staging import lean


def gold_summary(trips: DataFrame, payments: DataFrame, segments: DataFrame,
                 form: str = "as_written") -> DataFrame:
    """Key figures per body. See ``summary_over_children`` for the two forms."""
    return summary_over_children(
        trips, "id_viagem",
        {"cod_orgao_superior": "cod_orgao_superior", "orgao": "nome_orgao_superior"},
        total="valor_total", days="duracao_dias",
        payments=payments, payment_value="valor", segments=segments, form=form)


def build_gold(spark: SparkSession, database: str | None = None,
               form: str = "as_written") -> DataFrame:
    """Publish the gold table from the silver tables, and the view over it.

    A build that fails leaves the previous table and view, and queries that read the previous
    table can end. Of two builds at once one wins; the other raises ``PublishConflict``.
    """
    base = current_versions(spark, [GOLD_TABLE], database)
    trips, payments, segments = (
        spark.table(table_name(database, f"silver_{t}"))
        for t in ("viagem", "pagamento", "trecho"))
    with lean(spark):
        version = write_version(gold_summary(trips, payments, segments, form), GOLD_TABLE, database)
    publish(spark, {GOLD_TABLE: version}, database, base)
    gold = table_name(database, GOLD_TABLE)
    spark.sql(f"CREATE OR REPLACE VIEW {table_name(database, GOLD_VIEW)} AS SELECT * FROM {gold}")
    return spark.table(gold)
