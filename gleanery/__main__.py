"""python -m gleanery COMMAND."""

import sys

from gleanery.cli import main

if __name__ == "__main__":
    sys.exit(main())
