"""Every operator as a query over the given tables, with SQL that computes the same."""

from driftloom.catalogue import fits, gates, records, rollups, watching

CATALOGUE = {**rollups.QUERIES, **fits.QUERIES, **gates.QUERIES, **watching.QUERIES, **records.QUERIES}
