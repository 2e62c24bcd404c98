"""Independent DuckDB SQL for every registered query (the correctness oracle).

``ctes`` holds one SQL text per model (DuckDB dialect) and its dependencies;
``build(key)`` assembles a single ``WITH ... SELECT`` statement over the
pre-registered test tables.
"""
