"""Training-data operators: ten numbered operators and their queries.

Nothing outside this package imports it (``__spark_entry__.py`` adds its
queries only if it can be imported).  Each module holds one operator with its
own interface; ``queries.py`` holds the thin ``opN_*`` queries.
"""
