"""Every operator as a query over the driver's tables, with its SQL twin."""


def all_queries() -> dict:
    """name -> (callable(spark, folder) -> DataFrame, DuckDB SQL or None)."""
    from vitrine.showcase import changes, cleaning, files, publishing, runs, sites
    out: dict = {}
    for module in (changes, cleaning, files, publishing, runs, sites):
        clash = out.keys() & module.QUERIES.keys()
        if clash:
            raise ValueError(f"query names used twice: {sorted(clash)}")
        out |= module.QUERIES
    return out
