"""From raw dumps to the stored, checked catalogue as one job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmgrain import schemas
from filmgrain.operators import constraints
from filmgrain.plans import etl

RULES = constraints.declared(schemas.KEYS, schemas.PARENTS, schemas.TEXT_LIMITS)
#: Link tables filled from the principals, by the link's name there.
CAST_LINKS = {"actor": "actorid", "writer": "writerid", "director": "directorid", "producer": "producerid"}


def cleaned(dumps: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The normalised tables as the dumps give them; keys and parents are not checked yet."""
    genre, title_genre = etl.genres(dumps["title.basics"])
    role, actor_title_role = etl.roles(dumps["title.principals"])
    links = etl.principal_links(dumps["title.principals"])
    tables = {
        "title": etl.titles(dumps["title.basics"], dumps["title.ratings"]), "member": etl.members(dumps["name.basics"]),
        "genre": genre, "title_genre": title_genre, "role": role, "actor_title_role": actor_title_role,
    }
    for link, person in CAST_LINKS.items():
        tables[f"title_{link}"] = links.where(F.col("link") == link).select("titleid", F.col("person").alias(person))
    return {name: rows.select(*schemas.TABLES[name].names, *[c for c in rows.columns if c == constraints.POSITION])
            for name, rows in tables.items()}


def load_catalogue(dumps: Mapping[str, DataFrame], folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """(stored tables, rejects) below ``folder``; a run after a failed one writes the same again.

    A table's folder holds what was kept and what was not side by side, partitioned by outcome,
    so a reader of kept rows never opens the files of the others.
    """

    def store(name: str, judged: DataFrame) -> DataFrame:
        path = f"{folder.rstrip('/')}/{name}"
        judged.write.mode("overwrite").partitionBy("outcome").parquet(path)
        return judged.sparkSession.read.schema(judged.schema).parquet(path)

    return constraints.load(cleaned(dumps), RULES, store)
