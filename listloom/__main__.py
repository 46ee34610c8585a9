import sys

from listloom.cli import main

sys.exit(main())
