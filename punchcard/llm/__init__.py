"""Operations on text for training data: ten operators, each in a module of its own."""
