from tourledger.plans.run import main

main()
