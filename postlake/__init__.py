"""Job-board captures to clean postings, as Spark jobs."""

from postlake.plans.boards import BOARDS, DEFAULT_BOARD, board
from postlake.plans.run import RunResult, normalize, postings, run, run_all
from postlake.plans.staging import release
from postlake.sources.captures import read_captures, write_captures
from postlake.sources.snapshot import read_snapshot, write_snapshot

__all__ = [
    "BOARDS", "DEFAULT_BOARD", "RunResult", "board", "normalize", "postings", "read_captures", "read_snapshot",
    "release", "run", "run_all", "write_captures", "write_snapshot",
]
