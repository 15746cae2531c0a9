from tidewright.plans.cli import main

main()
