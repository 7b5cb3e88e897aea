import sys

from strata.cli import main

sys.exit(main())
