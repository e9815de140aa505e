"""SQL files of the SQL-file transforms shipped with the package."""
