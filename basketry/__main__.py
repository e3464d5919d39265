"""``python -m basketry`` runs the whole job (see ``basketry.run``)."""

from basketry.run import main

if __name__ == "__main__":
    main()
