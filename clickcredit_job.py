"""spark-submit launcher for the attribution job.

    spark-submit --py-files clickcredit.zip clickcredit_job.py <hits> <output_root> [options]

Same options as ``python -m clickcredit`` (see ``clickcredit/__main__.py``).
"""

from clickcredit.__main__ import main

if __name__ == "__main__":
    main()
