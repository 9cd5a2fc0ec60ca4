"""Following "next page" links through a page snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..scratch import materialize, materialize_counted
from .dedup import first_per


def one_per_url(pages: DataFrame) -> DataFrame:
    """One snapshot row per URL, the one with the lowest ``page_id``."""
    return first_per(pages, ["url"], ["page_id"])


def page_chain(links: DataFrame, starts: DataFrame, max_pages: int | None = None) -> DataFrame:
    """The pages reached from each start, with their place: ``start, url, page_seq``.

    ``links`` has one ``url, next_url`` per page, ``starts`` a distinct ``start``.
    A chain ends at a missing page, at a page it has visited, or, if that is given,
    after ``max_pages`` pages.

    Each round doubles the length of the known hops, so a chain of 500 pages
    takes nine joins, however many chains there are. A page has one next page,
    so a chain that meets a visited page only repeats itself from there on: the
    lowest place per page is the place it was visited at.

    A page that many others lead to is a hot key of these joins, of two columns each;
    adaptive execution splits it.
    """
    links = materialize(links.select("url", "next_url"))
    pages = links.select("url")
    reached, known = materialize_counted(
        starts.select("start", F.col("start").alias("url"))
        .distinct()
        .join(pages, "url", "left_semi")
        .where(F.lit(max_pages is None or max_pages > 0))
        .select("start", "url", F.lit(0).alias("page_seq"))
    )
    targets = pages.withColumnRenamed("url", "next_url")
    hop, n_hops = materialize_counted(
        links.join(targets, "next_url", "left_semi").select("url", "next_url")
    )
    length = 1
    while max_pages is None or length < max_pages:
        further = reached.join(hop, "url").select(
            "start",
            F.col("next_url").alias("url"),
            (F.col("page_seq") + length).alias("page_seq"),
        )
        if max_pages is not None:
            further = further.where(F.col("page_seq") < max_pages)
        before = known
        reached, known = materialize_counted(
            reached.unionByName(further)
            .groupBy("start", "url")
            .agg(F.min("page_seq").alias("page_seq"))
        )
        length *= 2
        if known == before or n_hops == 0:
            break
        if max_pages is None or length < max_pages:
            onward = hop.select(
                F.col("url").alias("next_url"), F.col("next_url").alias("then")
            )
            hop, n_hops = materialize_counted(
                hop.join(onward, "next_url").select("url", F.col("then").alias("next_url"))
            )
    return reached
