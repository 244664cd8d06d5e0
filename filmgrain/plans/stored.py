"""The normalised catalogue, stored once per folder and laid out by join key.

Links, titles and members are written as bucketed, sorted tables; dictionaries are numbered
once. Queries that read them join co-located buckets: no link is shuffled for a title join,
and nothing is made distinct again. Links between titles and actors are bucketed by the
whole pair, so a title with very many links is spread over the buckets; where people are the
selective side, a second copy by person is read.

A table is registered when its write has ended, so a failed run leaves no table behind, only
files that no table names. Bucket counts follow ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from filmgrain.operators.selection import dense_ids
from filmgrain.plans import integration
from filmgrain.plans.views import Catalogue, _role_label
from filmgrain.sources.writers import create_table_as
from filmgrain.workspace import stage_path

#: Columns by which each table is bucketed and sorted; none for dictionaries.
LAYOUT: dict[str, tuple[str, ...]] = {
    "genre": (), "role": (), "title": ("id",), "member": ("id",), "title_genre": ("titleid",),
    "title_producer": ("titleid",), "title_writer": ("titleid",), "title_director": ("titleid",),
    "title_actor": ("titleid", "actorid"),
    "actor_title_role": ("titleid", "actorid"), "actor_title": ("actorid",),
}
#: The same for the stored source views.
VIEW_LAYOUT: dict[str, tuple[str, ...]] = {
    "comedy_movie": ("id",), "non_comedy_movie": ("id",), "comedy_actor": ("id",), "non_comedy_actor": ("id",),
    "acted_in": ("titleid", "actorid"), "actor": ("id",),
}


def _kept(name: str, define: Callable[[StoredCatalogue], DataFrame] | None = None) -> cached_property:
    make = define or (lambda self: Catalogue.__dict__[name].func(self))
    return cached_property(lambda self: self.keep(name, make))


class StoredCatalogue(Catalogue):
    """The same views, read from stored tables; each is written on first use."""

    genre = _kept("genre", lambda self: dense_ids(self.part.selectExpr("p_type AS genre"), "genre"))
    role = _kept("role", lambda self: dense_ids(self.lineitem.select(_role_label().alias("role")), "role"))
    title = _kept("title")
    member = _kept("member")
    title_genre = _kept("title_genre")
    title_producer = _kept("title_producer")
    title_writer = _kept("title_writer")
    title_director = _kept("title_director")
    title_actor = _kept("title_actor")
    actor_title_role = _kept("actor_title_role")
    actor_title = _kept("actor_title", lambda self: self.title_actor)

    def source_views(self, kind: str) -> integration.Sources:
        """The source views for a genre, stored on first use and not refreshed.

        Links meet their movies once: they are stored with the movie's flag, the actors' flags come
        from there and are stored before both views of actors are drawn from them.
        """
        mark = hashlib.md5(kind.encode()).hexdigest()[:8]

        def kept(name: str, rows: DataFrame) -> DataFrame:
            return self.keep(f"{name}_{mark}", lambda self: rows, VIEW_LAYOUT[name])

        movies = integration.flagged_movies(self.title, integration.genre_flags(self.title_genre, self.genre, kind))
        cast = kept("acted_in", integration.flagged_links(self.title_actor, movies))
        actors = kept("actor", integration.actors_of(self.member, cast))
        views = integration.views(movies, actors, cast.select("titleid", "actorid"))
        return integration.Sources(**{
            name: rows if name == "acted_in" else kept(name, rows) for name, rows in views.items()
        })

    def keep(self, name: str, make: Callable[[StoredCatalogue], DataFrame], by: tuple[str, ...] | None = None) -> DataFrame:
        mark = hashlib.md5(f"{self.spark.sparkContext.applicationId}:{self.folder}".encode()).hexdigest()
        table = f"catalogue_{mark}_{name}"
        if not self.spark.catalog.tableExists(table):
            rows, by = make(self), LAYOUT[name] if by is None else by
            buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            if by:  # one file a bucket
                rows = rows.repartition(buckets, *by)
            create_table_as(rows, table, stage_path(self.spark, f"table-{name}"), by, buckets)
        return self.spark.table(table)


def stage(catalogue: Catalogue) -> StoredCatalogue:
    """All tables, written if they are not there yet."""
    stored = StoredCatalogue(catalogue.spark, catalogue.folder)
    for name in LAYOUT:
        getattr(stored, name)
    return stored
