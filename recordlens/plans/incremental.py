"""Entities of records that arrive in batches.

What is stored are the distinct profiles, to which profile each record belongs, and a
forest that links the profiles of an entity. A new batch is compared with itself and with
the stored profiles that share what a match needs; stored profiles are not compared with
each other again. Its links and the stored forest make the next forest.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.operators.components import star_forest
from recordlens.plans.resolution import PROFILE, ResolutionPipeline
from recordlens.storage import Workspace


class EntityStore:
    """A folder with the state of a resolution, which grows by batches.

    The entities are the same as of one resolution of all records, in whatever batches
    they come. A batch counts once it is written whole: what an interrupted ``add`` left
    behind is written over by the next one. One writer at a time.
    """

    def __init__(
        self, spark: SparkSession, folder: str, pipeline: ResolutionPipeline | None = None
    ) -> None:
        """Open the folder's state, or an empty one.

        Args:
            spark: The session.
            folder: Where the state lies, in a store that all machines share.
            pipeline: Scorer and options; the same for all batches of a folder.
        """
        self.spark = spark
        self.pipeline = pipeline or ResolutionPipeline()
        self.work = Workspace(spark, "entities", folder)
        self.n_batches = 0
        while self.work.holds(f"done-{self.n_batches}"):
            self.n_batches += 1

    def _stored(self, name: str) -> DataFrame | None:
        """The batches of a table, or None if there are none."""
        if not self.n_batches:
            return None
        paths = [f"{self.work.folder}/{name}-{i}" for i in range(self.n_batches)]
        return self.spark.read.parquet(*paths)

    def _forest(self) -> DataFrame | None:
        if not self.n_batches:
            return None
        return self.spark.read.parquet(f"{self.work.folder}/forest-{self.n_batches - 1}")

    def add(self, records: DataFrame) -> None:
        """Resolve a batch of new records against itself and what is stored.

        Args:
            records: With the pipeline's id, ``name``, ``email``, ``phone`` and ``city``; ids
                are new, of the same type in all batches, and may be smaller than stored ones.
        """
        pipeline, batch = self.pipeline, self.n_batches
        pipeline.check(records)
        rows = pipeline._clean(records)
        found = rows.groupBy(*PROFILE).agg(F.min("id").alias("first_id"))
        earlier, forest = self._stored("profiles"), self._forest()
        if earlier is None:
            no_node = F.lit(None).cast(found.schema["first_id"].dataType)
            known = found.withColumn("node", no_node)
        else:
            stored = earlier.select(
                F.col("first_id").alias("node"), *(F.col(c).alias(f"its_{c}") for c in PROFILE)
            )
            same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"its_{c}")) for c in PROFILE))
            known = found.join(stored, same, "left").select(*PROFILE, "first_id", "node")
        # A stored profile keeps its node, also if a smaller id turns up.
        known = self.work.keep(known.withColumn("own", pipeline._own()), f"found-{batch}")
        added = self.work.keep(
            known.filter("node IS NULL").select(*PROFILE, "first_id"), f"profiles-{batch}"
        )
        looking = Workspace(self.spark, "links")
        links = pipeline._shared_links(added, earlier)
        close = pipeline._close_links(added, looking, earlier)
        if close is not None:
            links = links.unionByName(close)
        again = known.filter("node IS NOT NULL AND own")
        links = links.unionByName(
            again.select(F.col("node").alias("low"), F.col("first_id").alias("high"))
        )
        if forest is not None:
            links = links.unionByName(forest)
        self.work.keep(star_forest(links, looking), f"forest-{batch}")
        looking.forget_all_but()
        nodes = known.select(
            F.when(F.col("own"), F.coalesce("node", "first_id")).alias("node"),
            *(F.col(c).alias(f"its_{c}") for c in PROFILE),
        )
        same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"its_{c}")) for c in PROFILE))
        self.work.keep(rows.join(nodes, same).select("id", "node"), f"members-{batch}")
        self.work.keep(self.spark.range(1), f"done-{batch}")
        self.n_batches += 1
        self.work.forget(f"found-{batch}", f"forest-{batch - 1}")

    def clusters(self) -> DataFrame:
        """One row per record so far, with its ``entity_id``; lazy, valid until the next batch."""
        members, forest = self._stored("members"), self._forest()
        if members is None:
            raise ValueError("no batch has been added")
        return members.join(forest, F.col("node") == F.col("high"), "left").select(
            F.col("id").alias(self.pipeline.id_col),
            F.coalesce("low", "node", "id").alias("entity_id"),
        )
