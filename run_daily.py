"""Daily batch entry point for spark-submit:

    spark-submit --py-files nightledger.zip run_daily.py --store ... --drop ...

(``python -m nightledger ...`` does the same without spark-submit.)
"""

from nightledger.__main__ import main

if __name__ == "__main__":
    main()
