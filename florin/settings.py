"""What an institution configures, as one value that travels with the report dates.

``ReportSpan.settings`` holds it, and every plan takes it from its span, so that reports of
several institutions can be planned in one session. The defaults are those of ``params``.
The lines of the statements are settings, too: a name and SQL over the metrics of
``plans.daily`` and the values derived from them.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, fields
from datetime import date
from decimal import Decimal
from itertools import pairwise

from florin import params

Accounts = Mapping[str, Sequence[str]]
Slots = Sequence[tuple[str, str]]


def _copy(value):
    """A field that starts as a copy of a fixed value."""
    return field(default_factory=lambda: dict(value) if isinstance(value, dict) else list(value))


def _plain(value):
    """Sequences as lists, mappings as dicts, whatever they were given as."""
    if isinstance(value, Mapping):
        return {name: _plain(one) for name, one in value.items()}
    return [_plain(one) for one in value] if isinstance(value, list | tuple) else value


@dataclass(frozen=True)
class Settings:
    # Holder, accounts, products
    holder: str = params.HOLDER
    investment_holder: str = params.INVESTMENT_HOLDER
    active: str = params.ACTIVE
    deposit_products: Sequence[str] = _copy(params.DEPOSIT_PRODUCTS)
    derivative_settlement: str = params.DERIVATIVE_SETTLEMENT
    bank_cutover: date = params.BANK_CUTOVER
    # Account groups by name; any number, each an own measure of the available funds.
    central_bank_accounts: Accounts = _copy(params.CENTRAL_BANK_ACCOUNTS)
    commercial_accounts: Accounts = _copy(params.COMMERCIAL_ACCOUNTS)
    usd_accounts: Accounts = _copy(params.USD_ACCOUNTS)
    statement_excluded_accounts: Sequence[str] = _copy(params.STATEMENT_EXCLUDED_ACCOUNTS)
    # Money market and securities
    depositories: Sequence[str] = _copy(params.DEPOSITORIES)
    government_species: str = params.GOVERNMENT_SPECIES
    private_species: str = params.PRIVATE_SPECIES
    dollar_nemo: str = params.DOLLAR_NEMO
    traded_sides: Sequence[str] = _copy(params.TRADED_SIDES)
    certificate_isin: str = params.CERTIFICATE_ISIN
    bond_isin: str = params.BOND_ISIN
    repurchase_participation: int = params.REPURCHASE_PARTICIPATION
    issuance_participation: int = params.ISSUANCE_PARTICIPATION
    # Accounting codes of movements without a concept
    code_normal_sb: str = params.CODE_NORMAL_SB
    code_normal_other: str = params.CODE_NORMAL_OTHER
    code_normal_of: str = params.CODE_NORMAL_OF
    code_sim_sell_spot: str = params.CODE_SIM_SELL_SPOT
    code_sim_sell_future: str = params.CODE_SIM_SELL_FUTURE
    code_sim_buy_spot: str = params.CODE_SIM_BUY_SPOT
    code_sim_buy_future: str = params.CODE_SIM_BUY_FUTURE
    code_ttv: str = params.CODE_TTV
    code_repo_buy: str = params.CODE_REPO_BUY
    code_repo_sell: str = params.CODE_REPO_SELL
    # Concept names
    yield_concept: str = params.YIELD_CONCEPT
    fx_concept: str = params.FX_CONCEPT
    otc_concept: str = params.OTC_CONCEPT
    named_codes: Mapping[str, str] = _copy(params.NAMED_CODES)
    unmapped_prefix: str = params.UNMAPPED_PREFIX
    debit_note: str = params.DEBIT_NOTE
    repurchase_concept: str = params.REPURCHASE_CONCEPT
    issuer_payment_concept: str = params.ISSUER_PAYMENT_CONCEPT
    gmf_concept: str = params.GMF_CONCEPT
    credit_interest_concept: str = params.CREDIT_INTEREST_CONCEPT
    third_party_concept: str = params.THIRD_PARTY_CONCEPT
    other_concepts: Sequence[str] = _copy(params.OTHER_CONCEPTS)
    clearing_expense_concepts: Sequence[str] = _copy(params.CLEARING_EXPENSE_CONCEPTS)
    other_operation_concepts: Sequence[str] = _copy(params.OTHER_OPERATION_CONCEPTS)
    # Payment channels; the bounds of a time slot belong to it
    ach_withdrawal: str = params.ACH_WITHDRAWAL
    ach_deposit: str = params.ACH_DEPOSIT
    ach_return: str = params.ACH_RETURN
    transfer_debit: str = params.TRANSFER_DEBIT
    transfer_credit: str = params.TRANSFER_CREDIT
    transfer_debit_return: str = params.TRANSFER_DEBIT_RETURN
    transfer_credit_return: str = params.TRANSFER_CREDIT_RETURN
    cross_deposit: str = params.CROSS_DEPOSIT
    excluded_channels: Sequence[str] = _copy(params.EXCLUDED_CHANNELS)
    credit_account: str = params.CREDIT_ACCOUNT
    confirming_account: str = params.CONFIRMING_ACCOUNT
    withdrawal_slots: Slots = _copy(params.WITHDRAWAL_SLOTS)
    deposit_slots: Slots = _copy(params.DEPOSIT_SLOTS)
    # Refund adapter
    unauthorized: str = params.UNAUTHORIZED
    out_suffix: str = params.OUT_SUFFIX
    sent_refund: str = params.SENT_REFUND
    late_cycle: int = params.LATE_CYCLE
    cycles: int = params.CYCLES
    originator_account: str = params.ORIGINATOR_ACCOUNT
    # Statement lines in order, and what instant payments add to every report date (an expense is positive)
    income_statement: Mapping[str, str] = _copy(params.INCOME_STATEMENT)
    expense_statement: Mapping[str, str] = _copy(params.EXPENSE_STATEMENT)
    instant_payment_income: Decimal | int | float | str = params.INSTANT_PAYMENT_INCOME
    instant_payment_expense: Decimal | int | float | str = params.INSTANT_PAYMENT_EXPENSE

    def __post_init__(self) -> None:
        for f in fields(self):
            object.__setattr__(self, f.name, _plain(getattr(self, f.name)))
        for name in ("withdrawal_slots", "deposit_slots"):
            object.__setattr__(self, name, [(start, end) for start, end in getattr(self, name)])
        _check_groups([*self.central_bank_accounts, *self.commercial_accounts, *self.usd_accounts], self.usd_accounts)
        _check_slots("withdrawal_slots", self.withdrawal_slots)
        _check_slots("deposit_slots", self.deposit_slots)
        for name in ("income_statement", "expense_statement"):
            _check_lines(name, getattr(self, name))
        for name in ("instant_payment_income", "instant_payment_expense"):
            object.__setattr__(self, name, _amount(name, getattr(self, name)))
        if not 1 <= self.late_cycle <= self.cycles:
            raise ValueError(f"late_cycle {self.late_cycle} is none of the {self.cycles} cycles")

    @property
    def transfer_channels(self) -> list[str]:
        return [self.transfer_debit, self.transfer_credit, self.transfer_debit_return, self.transfer_credit_return]

    def digest(self) -> str:
        """Equal for equal settings only, whatever the order of their account groups."""
        values = asdict(self) | {n: list(getattr(self, n).items()) for n in ("income_statement", "expense_statement")}
        text = json.dumps(values, sort_keys=True, default=str)
        return hashlib.sha256(text.encode()).hexdigest()


def settings_of(values: Mapping[str, object]) -> Settings:
    """Settings from names and values, as read from JSON; what is not named keeps its default."""
    unknown = sorted(set(values) - {f.name for f in fields(Settings)})
    if unknown:
        raise ValueError(f"no such settings: {', '.join(unknown)}")
    given = dict(values)
    if isinstance(given.get("bank_cutover"), str):
        given["bank_cutover"] = date.fromisoformat(given["bank_cutover"])
    return Settings(**given)


def _check_groups(groups: list[str], usd: Accounts) -> None:
    """Group names become column names next to those of the available funds."""
    reserved = {*params.AVAILABLE_COLUMNS, "report_date", "cut", "metric", "amount"}
    names = [name.lower() for name in [*groups, *[f"{name}_clearing" for name in usd]]]
    wrong = [name for name in groups if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_]*", name) or name.lower() in reserved]
    wrong += sorted({name for name in names if names.count(name) > 1})
    if wrong:
        raise ValueError(f"account groups cannot be named {', '.join(wrong)}")


def seconds_of_day(clock: str) -> int:
    found = re.fullmatch(r"([01]\d|2[0-3]):([0-5]\d):([0-5]\d)", clock)
    if not found:
        raise ValueError(f"no time of day: {clock!r}")
    hours, minutes, seconds = map(int, found.groups())
    return hours * 3600 + minutes * 60 + seconds


def _check_lines(name: str, lines: Mapping[str, str]) -> None:
    """Names of lines become column names of the output tables, next to their own columns."""
    reserved = {"total", "fecha_reporte", "fecha_generacion", params.PERCENTAGE_COLUMN}
    wrong = [n for n in lines if not re.fullmatch(r"[\w-]+", n) or n.lower() in reserved]
    lower = [n.lower() for n in lines]
    wrong += [n for n in lines if lower.count(n.lower()) > 1]
    wrong += [n for n, sql in lines.items() if not isinstance(sql, str) or not sql.strip()]
    if wrong or not lines:
        raise ValueError(f"{name} cannot have lines {', '.join(dict.fromkeys(wrong))}" if wrong else f"{name} has no line")


def _amount(name: str, value: object) -> Decimal:
    """An amount of the statements' precision."""
    try:
        found = Decimal(str(value))
    except ArithmeticError:
        raise ValueError(f"{name} {value!r} is no amount") from None
    if not found.is_finite() or abs(found) >= 10**14 or found != round(found, 4):
        raise ValueError(f"{name} {value!r} is no amount of 14 digits and four decimals")
    return found.quantize(Decimal("0.0001"))


def _check_slots(name: str, slots: Slots) -> None:
    bounds = [(seconds_of_day(start), seconds_of_day(end)) for start, end in slots]
    if any(start > end for start, end in bounds) or any(a[1] >= b[0] for a, b in pairwise(bounds)):
        raise ValueError(f"{name} must be in order and apart")


DEFAULT = Settings()
