"""Word lists, code lists and patterns of the business rules.

They must equal the agreed values for results to be right. Every operator takes them
as arguments, these are the defaults.
"""

# Residential customer types and live account states.
RESIDENTIAL_TYPES = ("RESIDENCIAL", "PROGRAMA HOGARES CONECTADOS")
LIVE_STATES = ("ACTIVO", "SUSPENDIDO")
CANCELLED_STATES = ("CANCELADA", "ANULADA")

# Contact purposes that are not customer-care contacts.
EXCLUDED_PURPOSES = (
    "VENTANILLA", "DESINSTALACION", "CORPORATIVO", "VENCIMIENTO PROMOCION",
    "*NO DEFINIDO*", "SUSPENSIONES", "CREACION DE FACTURA", "VENTAS",
)

# Technical contact purposes.
TECHNICAL_PURPOSES = (
    "AVERIAS", "SIN SERVICIO INTERNET", "INTERRUPCION CONSTANT SERVICIO",
    "EQUIPO INTEGRADO", "PROB VELOCIDAD", "SIN SEÑAL", "OTRO INTERNET",
    "CONTROL REMOTO", "SIN SERVICIO TV", "PROB STB DIG", "SIN SEÑAL UNO/VARIOS CH DVB",
    "PROB CABLE MODEM", "MENSAJE ERROR DVB", "PROB STB DVB", "MENSAJE ERROR",
    "INTERNET/DIGITAL", "CALIDAD SEÑAL", "TV/INTERNET/DIGITAL",
    "SIN SERVICIO TODOS LOS CH DVB", "SIN SERVICIO TELEFONIA", "CONTROL REMOTO DVB",
    "AVERIA", "PROB STB", "SEÑAL LLUVIOSA/RAYAS TV", "CONEXION", "TV/INTERNET",
    "FALTAN CH PARRILLA BASICA DVB", "NIVELES SEÑAL INCORRECTOS INT.", "TV/DIGITAL",
    "SIN SEÑAL UNO/VARIOS CH", "SIN SERVICIO INT", "PROB ROUTER CT", "CALIDAD SEÑAL DVB",
)

# Billing contact purposes.
BILLING_PURPOSES = (
    "INFORMACION", "MONTO DE FACTURACION", "NOTAS DE CREDITOS", "FACTURACION/COBROS",
    "FORMA DE PAGO", "CAMBIO DE PRECIO", "ANULACION DE FACTURA", "COSTO DE SERVICIOS",
    "ENVIO FACTURA", "NOTAS DE CREDITO",
)

# E-mail addresses that stand for "no e-mail". Deployments add the
# placeholder addresses of their own domain.
PLACEHOLDER_EMAILS = (
    "NOTIENE@GMAIL.COM", "NA@GMAIL.COM", "NO@GMAIL.COM", "NOTIENE@NOTIENE.COM",
)

# Mobile extract exclusions and dirty cells.
BUSINESS_SEGMENTS = ("Empresas - Empresas", "Empresas - Pymes")
EXCLUDED_MOBILE_PLANS = ("LA", "LB", "LC", "LD", "LE", "LF", "ST2")
EXCLUDED_MOBILE_USES = ("Moviles", "NO INFORMADO", "REVISAR")
NOT_A_DATE = (
    "#N/D", "SAMSUNG GALAXY A03 CORE 32GB NEGRO", "IPHONE 12 PRO MAX GRAFITO 256GB",
    "ARTICULO SIN EQUIPO",
)
MISSING_CONTRACT = ("", "#N/D")

# Province codes.
PROVINCES = {
    "1": "Bocas del Toro", "2": "Cocle", "3": "Colon", "4": "Chiriqui", "5": "Darien",
    "6": "Herrera", "7": "Los Santos", "8": "Panama", "9": "Veraguas", "10": "Panama Oeste",
}

# Claim categories and the patterns that select them, in order.
CLAIM_PATTERNS = (
    ("retention_claim", ("%retenci%n%",)),
    ("service_restriction_claim", ("%restringido%",)),
    ("installation_claim", ("%instalacion%",)),
    ("account_info_or_balance_claim", (
        "%afiliacion%factura%", "%cliente%desc%", "%consulta%cuentas%",
        "%consulta%productos%", "%consumo%", "%info%cuenta%productos%",
        "%informacion%general%", "%pagar%on%line%", "%saldo%", "%actualizacion%datos%",
        "%traslado%linea%", "%transfe%cta%")),
    ("billing_claim", (
        "%cargo%", "%credito%", "%facturaci%n%", "%pago%", "%prorrateo%",
        "%alto%consumo%", "%investigacion%interna%", "%cambio%descuento%")),
    ("sales_claim", (
        "%venta%", "%publicidad%", "%queja%promo%precio%", "%promo%",
        "%cambio%de%precio%", "%activacion%producto%", "%productos%servicios%-internet%",
        "%productos%servicios%suplementarios%", "%paytv%-tv%digital%hd%")),
    ("customer_service_claim", (
        "%queja%mala%atencion%", "%dunning%", "%consulta%reclamo%", "%apertura%reclamo%",
        "%horario%tienda%", "%consulta%descuento%", "%cuenta%apertura%reclamo%",
        "%actualizar%apc%", "%felicita%")),
    ("technical_claim", (
        "% da%no%", "%-da%no%", "%servicios%-da%os%", "%datos%internet%",
        "%equipo%recuperado%", "%escalami%niv%", "%queja%internet%", "%queja%linea%",
        "%queja%tv%", "%reclamos%tv%", "%serv%func%", "%soporte%internet%",
        "%soporte%linea%", "%tecn%", "%no%casa%internet%", "%no%energia%internet%",
        "%soporte%", "%intermiten%", "%masivo%")),
)
CLAIM_TYPES = {
    "billing_claim": "Billing",
    "account_info_or_balance_claim": "Account Info",
    "retention_claim": "Retention",
    "installation_claim": "Technical",
    "tech_ticket": "Technical",
    "tech_truckroll": "Technical",
    "technical_claim": "Technical",
}

# Patterns that make or unmake a technical call.
TECH_CALL_INCLUDE = (
    "%ppv%problem%", "%hsd%problem%", "%cable%problem%", "%tv%problem%",
    "%video%problem%", "%tel%problem%", "%phone%problem%", "%int%problem%",
    "%line%problem%", "%hsd%issue%", "%ppv%issue%", "%video%issue%", "%tel%issue%",
    "%phone%issue%", "%int%issue%", "%line%issue%", "%cable%issue%", "%tv%issue%",
    "%bloq%", "%slow%", "%slow%service%", "%service%tech%", "%tech%service%",
    "%no%service%", "%hsd%no%", "%hsd%slow%", "%hsd%intermit%", "%no%brows%",
    "%phone%cant%", "%phone%no%", "%no%connect%", "%no%conect%", "%no%start%",
    "%equip%", "%intermit%", "%no%dat%", "%dat%serv%", "%int%data%", "%tech%",
    "%supp%", "%outage%", "%mass%", "%discon%warn%",
)
TECH_CALL_EXCLUDE = (
    "%work%order%status%", "%default%call%wrapup%", "%bound%call%", "%cust%first%",
    "%audit%", "%eq%code%", "%downg%", "%upg%", "%vol%discon%", "%discon%serv%",
    "%serv%call%",
)

# Sales-channel groups. Exact names first, then fragments.
CHANNEL_GROUPS = (
    ("D2D (Own Sales force)",
     ("Provincia de Chiriqui", "PROM", "VTASE", "PHs1", "Busitos", "Alianza", "Coronado",
      "Ventas Externas/ADSL", "PHs 2"),
     ("PROM", "VTASE", "Busitos", "Alianza")),
    ("D2D (Outsourcing)",
     ("Dinamo", "Oficinista", "Distribuidora Arandele", "Orde Technology", "SLAND",
      "SI Panamá"), ()),
    ("Retail (Own Stores)",
     ("Vendedores", "Metro Mall", "WESTLAND MALL", "TELEMART AGUADULCE"), ()),
    ("Outbound – TeleSales", ("123 Outbound", "Gestión"), ("Gestión", "Gestion")),
    ("Inbound – TeleSales",
     ("Centro de Retencion", "Centro de Llamadas", "Call Cnter MULTICALL"), ()),
    ("Digital", ("Nestrix", "Tienda OnLine", "Live Person", "Telefono"), ()),
    ("Retail (Distributer-Dealer)", ("Panafoto Dorado", "Agencia"), ("Agencia", "AGENCIA")),
    ("Not a Sales Channel",
     ("CIS+ GUI", "Solo para uso de IT", "Apuntate", " CU2Si", "RC0E Collection", "Carta",
      "Proyecto", "DE=Demo", "Recarga saldo", "Port Postventa", "Feria", "Administracion",
      "Postventa-verif.orde", "No Factibilidad", "Orden a construir", "Inversiones AP",
      "Promotor", "VIVI MAS"),
     ("Feria",)),
)

# Order types and the command codes of transfers and delinquency.
INSTALL, DEINSTALL = "INSTALACION", "DESINSTALACION"
FINISHED = "FINALIZADA"
DELINQUENCY_CODES = ("MOROSIDAD",)
TRANSFER_OUT_CODES = ("TRAMITE INTERNO", "DESINSTALACION POR TX")
TRANSFER_OUT_PREFIX = "MIGRACION"
TRANSFER_IN_CODES = ("CAMBIO NOMBRE", "INSTALACION POR TX", "TRAMITE INTERNO")

# Movement-log codes and descriptions.
LOG_LEAVE, LOG_SWITCH = "BAJAS", "CAMBIO PRODUCTO"
LOG_OUT, LOG_IN = "SALIDAS", "ENTRADAS"
VOLUNTARY_DESCRIPTIONS = ("Bajas por solicitud voluntaria", "No Determinada")
INVOLUNTARY_DESCRIPTIONS = ("Bajas por morosidad", "Bajas por Suspensión Morosidad")

# Mobile movement file.
MOBILE_OUT_MIGRATION, MOBILE_LEAVE = "Migraciones Out", "Bajas"
MOBILE_INVOLUNTARY, MOBILE_PORT_OUT, MOBILE_VOLUNTARY = (
    "BAJA INVOLUNTARIA", "BAJA PORTABILIDAD", "BAJA VOLUNTARIA",
)

# Churn and rejoiner labels.
FIXED_VOLUNTARY = "1. Fixed Voluntary Churner"
FIXED_INVOLUNTARY = "2. Fixed Involuntary Churner"
FIXED_ATYPICAL = "3. Atipicos"
FIXED_EARLY = "3. Early Disconnection"
FIXED_REJOINERS = {
    FIXED_VOLUNTARY: "1. Fixed Voluntary Rejoiner",
    FIXED_INVOLUNTARY: "2. Fixed Involuntary Rejoiner",
}
MOBILE_VOLUNTARY_CHURN = "1. Mobile Voluntary Churner"
MOBILE_INVOLUNTARY_CHURN = "2. Mobile Involuntary Churner"
MOBILE_STAYS = "3. Mobile NonChurner"
MOBILE_REJOINERS = {
    MOBILE_VOLUNTARY_CHURN: "1. Mobile Voluntary Rejoiner",
    MOBILE_INVOLUNTARY_CHURN: "2. Mobile Involuntary Rejoiner",
}
TRANSFER_OUT, TRANSFER_IN = "01. Transfer Out", "02. Transfer In"

# Main movement labels.
SAME, UPSELL, DOWNSELL, COME_BACK, NEW, LOSS, MISSING, TO_BUSINESS = (
    "01. Same RGUs", "02. Upsell", "03. Downsell", "04. Come Back to Life",
    "05. New Customer", "06. Loss", "07. Missing Customer", "07.B2C to B2B Adjustment",
)
