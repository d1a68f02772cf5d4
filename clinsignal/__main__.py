from clinsignal.cli import main

main()
