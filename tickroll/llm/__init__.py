"""Training-data operators (numbered as dealt) and their registered queries.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries only when the folder is there.
"""
