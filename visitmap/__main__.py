from visitmap.job import main

main()
