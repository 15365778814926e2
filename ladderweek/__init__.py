"""Weekly fish-passage analytics as Spark DataFrames.

Every builder takes and returns DataFrames keyed by ``run_id`` (one dam, species and season), so a single job
handles all dams, species and years at once.
"""

from ladderweek.config import Run, Seasons
from ladderweek.session import build_session

__all__ = ["Run", "Seasons", "build_session"]
