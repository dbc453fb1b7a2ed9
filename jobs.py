"""Entry point for spark-submit; see `cellhours/__main__.py` for the jobs."""

import sys

from cellhours.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
