"""Operations of a training-data pipeline over text and vectors; nothing else in the library imports this package."""
