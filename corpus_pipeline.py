"""From raw documents to packed training sequences: the stages of ``genespark.llm.pipeline``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``. ``run`` applies them to the documents of a folder.
"""

from __future__ import annotations

from genespark.llm.pipeline import ORACLE_SQL, STAGES, near_duplicates, pack, personal_data, quality_rules, repeated_passages, run

__all__ = ["ORACLE_SQL", "STAGES", "near_duplicates", "pack", "personal_data", "quality_rules", "repeated_passages", "run"]
