"""Load the deliveries of one batch date: ``spark-submit run_daily.py <yyyymmdd> ...``."""

import sys

from tidemark.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
