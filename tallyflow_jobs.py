"""Script for ``spark-submit``: the first argument is the job, the rest its arguments."""

from tallyflow.jobs import main

if __name__ == "__main__":
    main()
