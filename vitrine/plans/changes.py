"""Change detection end to end: joined once, reported many times."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from vitrine.operators import diff as X
from vitrine.session import shuffles_dropped, stored
from vitrine.sources import writers


@dataclass(frozen=True)
class Changes:
    diff: DataFrame
    counts: DataFrame
    new: DataFrame
    removed: DataFrame
    prices: DataFrame
    colors: DataFrame
    updated: DataFrame
    images: DataFrame
    deletions: DataFrame
    links: DataFrame
    fresh: DataFrame
    ready: DataFrame


def detect_changes(scan: DataFrame, catalog: DataFrame, variants: DataFrame, listing: DataFrame,
                   materialize: bool = True) -> Changes:
    """All change tables of a scan against the catalogue.

    The joined table feeds the reports, and so do the scan rows and the variant keys
    they ask for, so these are written once to the shared checkpoint folder instead of
    being joined again by each of them.
    """
    diff = X.diff_catalog(scan, catalog)
    if materialize:
        diff = stored(diff)
        scan, variants = stored(X.reported_rows(scan, diff)), stored(X.lost_variants(diff, variants))
    links = X.links_by_code(listing)
    return Changes(
        diff=diff, counts=X.change_counts(diff), new=X.new_manifest(scan, catalog, links, diff),
        removed=X.removed_products(diff, catalog, variants), prices=X.price_changes(diff),
        colors=X.color_changes(diff, variants), updated=X.update_manifest(diff, links),
        images=X.image_subset(diff, scan, links), deletions=X.delete_list(diff, variants),
        links=X.link_sheet(diff.filter("change_class = 'new' or color_added"), links),
        fresh=X.new_sheet(diff, scan), ready=X.ready_sheet(diff, scan))


def choose_mode(counts: DataFrame, has_catalog: bool, requested: str = "auto") -> dict:
    """What the run has to do, from one row of counts."""
    if requested == "full" or not has_catalog:
        return {"mode": "full", "stop": False, "images": True}
    row = counts.first()
    changed = row["new"] + row["changed"]
    return {"mode": "incremental", "stop": changed == 0, "images": row["new"] + row["color"] > 0}


def write_changes(changes: Changes, path: str, compression: str | None = None) -> None:
    """All sheets, manifests and the deletion list; ``compression`` is a codec of text files."""
    with shuffles_dropped(changes.diff.sparkSession):
        writers.write_sheets({"summary": changes.counts, "removed": changes.removed,
                              "price": X.price_sheet(changes.prices), "color": changes.colors,
                              "links": changes.links, "new": changes.fresh, "ready": changes.ready}, f"{path}/report", compression)
        writers.write_manifests(changes.new, changes.updated, changes.images, path, compression)
        writers.write_delete_list(changes.deletions, f"{path}/skus_to_delete", compression)
