"""Scans: landed feed pages, CRM tables, keyed text/artifact stores, and
the overlay that presents the driver's test tables as domain tables."""
