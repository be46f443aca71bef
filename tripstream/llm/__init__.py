"""Operators of a training-data pipeline (WARC bundles, deduplication, packing,
filters). Nothing else in the package imports this subpackage; the driver
contract adds its queries when it is present."""
