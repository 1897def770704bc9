"""spark-submit entry point for the batch job (see ``salesengine.__main__``).

    spark-submit --py-files salesengine.zip job.py --raw RAW --out OUT [--generate N]
"""

from salesengine.__main__ import main

if __name__ == "__main__":
    main()
