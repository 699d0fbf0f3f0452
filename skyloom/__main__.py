from skyloom.jobs import main

main()
