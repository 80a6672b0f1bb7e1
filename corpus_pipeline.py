"""The corpus pipeline; its stages are in vitrine.llm.stages."""

from __future__ import annotations

from vitrine.llm.stages import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
