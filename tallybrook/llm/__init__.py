"""Operations of a large text-data pipeline; nothing else in the library imports them."""
