import sys

from folioforge.cli import main

sys.exit(main())
