"""The corpus pipeline's stages; they are in ``barline.llm.pipeline``."""

from barline.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
