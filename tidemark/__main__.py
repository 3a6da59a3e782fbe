from tidemark.jobs import main

main()
