"""Driver script for ``spark-submit --py-files plumbline.zip run_job.py <job> ...``."""

from plumbline.jobs import main

if __name__ == "__main__":
    main()
