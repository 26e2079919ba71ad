"""Retail order analytics as plain DataFrame functions.

Sales lines, customers and a keyed weather lookup go in; an enriched fact,
data-quality reports, four metric tables, merged target tables and the usual
reports come out.
"""
