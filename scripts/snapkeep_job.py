"""Launcher for spark-submit: ``spark-submit [--py-files snapkeep.zip] scripts/snapkeep_job.py <job> ...``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snapkeep.cli import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
