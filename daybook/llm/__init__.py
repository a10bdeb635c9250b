"""Corpus preparation operators for training data.

Ten operators (packing, fingerprints, near-duplicate documents, fuzzy line removal, language
identification, nearest neighbours, secret scans, BPE encoding, URL filters, sharding), one module
each.  ``registered`` holds their queries, ``oracle`` their DuckDB SQL.  Nothing outside this
package imports it.
"""
