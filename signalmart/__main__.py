import sys

from signalmart.cli import main

sys.exit(main())
