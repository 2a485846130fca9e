from trip_star.cli import main

main()
