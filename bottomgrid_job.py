"""spark-submit driver for the scheduled jobs:

    spark-submit --py-files bottomgrid.zip bottomgrid_job.py step1 ...
"""

from bottomgrid.cli import main

if __name__ == "__main__":
    main()
