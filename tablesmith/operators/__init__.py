"""DataFrame -> DataFrame operators. None of them runs an action unless a
check is asked for (uniqueness, size bound); those are documented per function."""
