import sys

from panelforge.cli import main

sys.exit(main())
