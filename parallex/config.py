"""Options object and fixed constants."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values. Special tokens and their reserved ids, in id order.
# [SOS], [EOS] and [PAD] are the names the model code looks up; [UNK] is the id
# every out-of-vocabulary token maps to. Real tokens get ids from 4 upwards.
SPECIAL_TOKENS = ("[UNK]", "[PAD]", "[SOS]", "[EOS]")
UNK_ID, PAD_ID, SOS_ID, EOS_ID = 0, 1, 2, 3


@dataclass(frozen=True)
class Options:
    """Run settings. The defaults are the reference's default
    configuration (batch 6, 10 epochs, sequence length 480, en -> ja, artifact
    folder ``opus100_weights`` with files ``tmodel_NN.pt``, latest artifact
    preloaded, 90 % train split, label smoothing 0.1, 2 validation examples,
    validation batch 1). ``seed`` is ours: the reference does not seed."""

    batch_size: int = 6
    num_epochs: int = 10
    seq_len: int = 480
    src_lang: str = "en"
    trg_lang: str = "ja"
    datasource: str = "opus100"
    model_folder: str = "weights"
    model_basename: str = "tmodel_"
    preload: str | None = "latest"
    train_fraction: float = 0.9
    label_smoothing: float = 0.1
    val_examples: int = 2
    val_batch_size: int = 1
    seed: int = 42

    @property
    def artifact_folder(self) -> str:
        return f"{self.datasource}_{self.model_folder}"
