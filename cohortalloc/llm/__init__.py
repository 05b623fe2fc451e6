"""Training-data operators: fingerprints, scans, search, dedup, tokens, HTML, chat, mixing, language.

Each module holds one operator with its own general interface; ``queries``
holds the thin registered queries over the standard tables.  Nothing outside
this subpackage imports it.
"""
