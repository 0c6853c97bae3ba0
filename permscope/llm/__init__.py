"""Training-data operators (deduplication, packing, quality, WARC, licences).

Nothing else in the library imports this subpackage.  Each operator module
has a general ``DataFrame -> DataFrame`` interface; ``queries.py`` holds the
thin registered queries.
"""
