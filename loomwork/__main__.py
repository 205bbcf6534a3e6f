"""Command line: load a dump."""

import sys

from loomwork.plans.pipeline import main

sys.exit(main())
