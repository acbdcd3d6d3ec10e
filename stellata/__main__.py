import sys

from stellata.cli import main

main(sys.argv[1:])
