"""Training-data operators (quality, tokens, mixing, extraction, sharding, duplicates, safety).

Nothing outside this subpackage imports it; ``queries.py`` holds the
registered queries and their SQL."""
