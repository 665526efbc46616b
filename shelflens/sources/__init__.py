"""Sources and sinks.

files        CSV/TSV readers (fixed, vendor and ragged layouts) and report writers
marketplace  sales history, listing snapshot, catalog lookup/enrichment, demo data
tables       SKU-bucketed tables for shuffle-free repeated reports
fixtures     adapters that present the test tables as listings, sales and exports
"""
