"""Entry point for spark-submit: ``spark-submit run_job.py star sales.csv output``."""

from tallystar.plans.jobs import main

if __name__ == "__main__":
    main()
