import sys

from rillet.cli import main

sys.exit(main())
