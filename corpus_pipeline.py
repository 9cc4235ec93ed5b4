"""A corpus pipeline of five stages: each works on all documents that the stage before it kept.

run(spark, sf_dir) applies them to documents and returns the packed pieces. Each stage's result is written
as Parquet in the shared folder and read again as the next one's input.
"""

from curafold.llm.pipeline import STAGES, exact, near, packed, private, quality, run

#: SQL can't express the trained, hashed and packed stages; tests/llm holds them against brute force.
ORACLE_SQL = None

__all__ = ["ORACLE_SQL", "STAGES", "exact", "near", "packed", "private", "quality", "run"]
