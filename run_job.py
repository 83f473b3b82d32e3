"""Launcher for spark-submit: ``spark-submit --py-files rillet.zip run_job.py <job> [options]``."""

import sys

from rillet.cli import main

if __name__ == "__main__":
    sys.exit(main())
