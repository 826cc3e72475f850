from cardrisk.plans.jobs import main

main()
