"""Launcher for spark-submit: ``spark-submit --py-files terrace.zip run_terrace.py <stage> ...``."""

import sys

from terrace.__main__ import main

if __name__ == "__main__":
    main(sys.argv[1:])
