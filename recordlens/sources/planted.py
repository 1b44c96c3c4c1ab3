"""Known truth planted into rows that are there already.

Anomalies are real values of chosen rows, multiplied; duplicates are copies of real
records with small changes. Which rows are chosen and how they change follows from
digests of their ids, so it does not depend on partitions or retries. The two
generators make small inputs for trials without any table.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from recordlens.functions.draws import near_normal, uniforms, whole
from recordlens.functions.names import named

TRANSACTIONS = StructType(
    [
        StructField("txn_id", LongType(), False),
        StructField("customer_id", LongType(), False),
        StructField("amount", DoubleType(), False),
        StructField("is_anomaly", LongType(), False),
    ]
)
CUSTOMERS = StructType(
    [
        StructField("record_id", LongType(), False),
        StructField("name", StringType()),
        StructField("email", StringType()),
        StructField("phone", StringType()),
        StructField("city", StringType()),
        StructField("true_entity_id", LongType(), False),
    ]
)
# A record id is COPY_SLOTS * entity + copy, with copy 0 for the original.
COPY_SLOTS = 4


def _typed(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, in its order and with its types."""
    return df.select(*(named(f.name).cast(f.dataType).alias(f.name) for f in schema))


def plant_anomalies(
    rows: DataFrame,
    *,
    id_col: str = "txn_id",
    value_col: str = "amount",
    rate: float = 0.01,
    factor: float = 12.0,
    seed: int = 5,
) -> DataFrame:
    """The rows with ``is_anomaly``, and the values of a share of them times ``factor``."""
    odd = uniforms(f"{seed}|odd", named(id_col), count=1)[0] < F.lit(rate)
    value = named(value_col)
    return rows.withColumns(
        {
            value_col: F.when(odd, value * F.lit(factor)).otherwise(value),
            "is_anomaly": odd.cast("bigint"),
        }
    )


def changed_name(name: Column, style: Column, place: Column) -> Column:
    """A variant of a name that keeps its first letter.

    Below 0.4 of ``style`` a letter is doubled, below 0.7 two neighbours change places,
    else the name is in capitals. ``place`` picks the letter. Names of fewer than three
    letters stay as they are.
    """
    at = F.lit(2) + F.floor(place * (F.length(name) - 2)).cast("int")
    rest = F.length(name)

    def part(start: Column, length: Column) -> Column:
        return F.substring(name, start, length)

    one = F.lit(1)
    doubled = F.concat(part(one, at), part(at, rest))
    swapped = F.concat(part(one, at - 1), part(at + 1, one), part(at, one), part(at + 2, rest))
    return (
        F.when(F.length(name) < 3, name)
        .when(style < 0.4, doubled)
        .when(style < 0.7, swapped)
        .otherwise(F.upper(name))
    )


def plant_duplicates(
    records: DataFrame, *, id_col: str = "record_id", dup_rate: float = 0.25, seed: int = 17
) -> DataFrame:
    """The records, a share of them with one to three changed copies behind them.

    ``records`` have ``id_col``, name, email, phone and city. In copies the name is a
    variant; the email is missing, blank or set off by spaces and capitals in a tenth,
    a fifth and a third of cases; the phone is blank in a tenth and has other
    punctuation in a quarter. The new id holds entity and copy, and ``true_entity_id``
    is the old id.
    """
    entity = named(id_col)
    chance, amount = uniforms(f"{seed}|copies", entity, count=2)
    copies = F.when(chance < F.lit(dup_rate), whole(amount, 1, COPY_SLOTS - 1)).otherwise(0)
    rows = records.select(
        entity.alias("entity"),
        *("name", "email", "phone", "city"),
        F.explode(F.sequence(F.lit(0), copies)).alias("copy"),
    )
    style, place, mail, tel = uniforms(f"{seed}|copy", F.col("entity"), F.col("copy"), count=4)
    drawn = rows.select(
        "*", style.alias("style"), place.alias("place"), mail.alias("mail"), tel.alias("tel")
    )
    original, mail, tel = F.col("copy") == 0, F.col("mail"), F.col("tel")
    return _typed(
        drawn.select(
            (F.col("entity") * COPY_SLOTS + F.col("copy")).alias("record_id"),
            F.when(original, F.col("name"))
            .otherwise(changed_name(F.col("name"), F.col("style"), F.col("place")))
            .alias("name"),
            F.when(original, F.col("email"))
            .when(mail < 0.1, F.lit(None))
            .when(mail < 0.3, F.lit(""))
            .when(mail < 0.6, F.concat(F.lit(" "), F.upper("email"), F.lit(" ")))
            .otherwise(F.col("email"))
            .alias("email"),
            F.when(original, F.col("phone"))
            .when(tel < 0.1, F.lit(""))
            .when(tel < 0.35, F.concat(F.lit("("), "phone", F.lit(")")))
            .otherwise(F.col("phone"))
            .alias("phone"),
            "city",
            F.col("entity").alias("true_entity_id"),
        ),
        CUSTOMERS,
    )


@dataclass(frozen=True)
class SyntheticTransactions:
    """Transactions of ``n_customers`` with ``txns_per_customer`` each, some anomalous."""

    n_customers: int = 150
    txns_per_customer: int = 60
    anomaly_rate: float = 0.01
    seed: int = 5
    name: ClassVar[str] = "synthetic_transactions"

    def load(self, spark: SparkSession) -> DataFrame:
        """The transactions (txn_id, customer_id, amount, is_anomaly)."""
        customer = F.floor(F.col("id") / self.txns_per_customer)
        level = uniforms(f"{self.seed}|level", customer, count=1)[0]
        noise = near_normal(uniforms(f"{self.seed}|noise", F.col("id"), count=12))
        rows = spark.range(self.n_customers * self.txns_per_customer).select(
            F.col("id").alias("txn_id"),
            customer.alias("customer_id"),
            ((F.lit(20.0) + F.lit(80.0) * level) * F.exp(F.lit(0.1) * noise)).alias("amount"),
        )
        return _typed(
            plant_anomalies(rows, rate=self.anomaly_rate, seed=self.seed), TRANSACTIONS
        )


@dataclass(frozen=True)
class SyntheticCustomers:
    """Records of ``n_entities`` customers, ``dup_rate`` of them with changed copies."""

    n_entities: int = 250
    dup_rate: float = 0.25
    seed: int = 17
    name: ClassVar[str] = "synthetic_customers"

    def load(self, spark: SparkSession) -> DataFrame:
        """The records (record_id, name, email, phone, city, true_entity_id)."""
        key = F.md5(F.concat_ws("|", F.lit(str(self.seed)), F.col("id").cast("string")))
        # Hex digits read as letters a to p, so that names and cities look like words.
        letters = F.translate(key, "0123456789abcdef", "abcdefghijklmnop")
        number = F.conv(F.substring(key, 20, 8), 16, 10)
        rows = spark.range(self.n_entities).select(
            F.col("id").alias("record_id"),
            F.concat(F.substring(letters, 1, 5), F.lit(" "), F.substring(letters, 6, 7)).alias(
                "name"
            ),
            F.concat(F.substring(letters, 1, 9), F.lit("@"), F.col("id"), F.lit(".test")).alias(
                "email"
            ),
            F.lpad(number, 10, "0").alias("phone"),
            F.concat(F.substring(letters, 31, 1), F.lit("ton")).alias("city"),
        )
        return plant_duplicates(rows, dup_rate=self.dup_rate, seed=self.seed)
